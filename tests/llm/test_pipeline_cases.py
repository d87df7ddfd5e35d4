"""The pipeline over empty tables, null and repeated rows, ties and clashing columns; what every stage does with them."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, at, documents, labels=(), benchmark=()):
    docs = spark.createDataFrame(documents, DOCUMENTS).selectExpr("*", "1 AS key", "'x' AS component", "2 AS score", "3 AS h", "4 AS rank", "5 AS length", "6 AS piece", "'s' AS spans", "7 AS predicted", "8 AS item_id")
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality long, toxic long").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, tables(spark, tmp_path, []))
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    copy = " ".join(f"word{i}" for i in range(60))
    item = " ".join(f"item{i}" for i in range(30))
    rows = [
        (1, None), (2, ""), (2, ""), (None, None), (3, copy), (3, copy), (4, copy + " more"), (None, copy), (5, "quite different text about rivers and hills of the north"),
        (6, "before it " + item + " behind it"), (None, item), (7, "password: hunter2hunter2 stays masked in this line of text here"), (8, " \t\n "), (9, "one"), (10, "one"),
    ]
    sf_dir = tables(spark, tmp_path_factory.mktemp("cases"), [(i, t, "en", "web", len(t or "")) for i, t in rows], benchmark=[(1, item), (2, None), (3, "")])
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        kept[name] = docs
    return rows, kept


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_without_labels_nothing_is_toxic(results):
    rows, kept = results
    assert texts(kept["toxicity"]) == sorted(rows, key=str)


def test_one_row_of_each_group_stays(results):
    rows, kept = results
    got = texts(kept["ngram_jaccard"])
    copies = [r for r in got if r[1] and r[1].startswith("word0")]
    assert copies == [(3, rows[4][1])]
    # of equal short texts the smallest id; rows without words stay, repeated or not
    assert [r for r in got if r[1] == "one"] == [(9, "one")]
    assert sum(not (r[1] or "").strip() for r in got) == 5


def test_leaks_go_and_secrets_are_masked(results):
    _, kept = results
    got = texts(kept["decontamination"])
    assert not any("item3 item4" in (t or "") for _, t in got) and len(got) == kept["ngram_jaccard"].count() - kept["ngram_jaccard"].filter("text LIKE '%item3 item4%'").count()
    masked = dict(texts(kept["secret_scan"]))
    assert "hunter2" not in masked[7] and "[SECRET]" in masked[7] and masked[7].endswith("stays masked in this line of text here")
    assert kept["secret_scan"].columns == kept["toxicity"].columns


def test_everything_left_is_packed_once(results):
    _, kept = results
    pieces = kept["best_fit_packing"]
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, zlib.crc32(np.array([*LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for r in kept["secret_scan"].collect())
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids_crc32"]) for r in pieces.collect()) == want
    ends = pieces.groupBy("sequence_id").agg(F.max(F.col("offset") + F.col("length")).alias("end"), F.sum("length").alias("all"))
    assert ends.filter("end != `all` OR end > 1024").count() == 0
