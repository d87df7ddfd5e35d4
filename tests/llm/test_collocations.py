"""Phrase counts against plain counting, the quicksort against a dictionary, and the query against its SQL on odd texts."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from thermaspark.llm import collocations as C

FOLDED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least):
    f = collections.Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLDED)):
            w = re.findall("[^ \t]+", piece)
            for i in range(len(w)):
                for k in range(1, 4):
                    if i + k <= len(w):
                        f[lang or "und", " ".join(w[i : i + k])] += 1
    return {k: n for k, n in f.items() if n >= least}


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts_every_frequent_head(seed):
    r = np.random.default_rng(seed)
    rows = np.sort(r.zipf(1.5, (3000, 3)).clip(1, 40).astype(np.int32) * (r.random((3000, 3)) < 0.9), 1)[:, ::-1].copy()
    times = r.integers(1, 4, 3000)
    want = collections.Counter()
    for row, n in zip(rows.tolist(), times.tolist(), strict=True):
        for k in range(1, 4):
            if all(row[:k]):
                want[tuple(row[:k])] += n
    for floors in ((10, 10, 10), (1, 10, 10), (1, 1, 10)):
        got = {}
        for size, at, f in C.equal_partitions(rows, times, floors):
            for i, n in zip(at.tolist(), f.tolist(), strict=True):
                assert tuple(rows[i, :size].tolist()) not in got
                got[tuple(rows[i, :size].tolist())] = n
        assert got == {k: n for k, n in want.items() if n >= floors[len(k) - 1]}


def odd_rows(seed=3, n=300):
    r = random.Random(seed)
    words = ["the", "The", "of", "a", "New", "york", "city", "é", "中文", "x\x1cy", "\xa0", "b" * 70]
    out = [(None, None), ("en", ""), ("en", " ,. "), (None, "Only. Once"), ("de", "new york city, " * 12)]
    for _ in range(n):
        text = "".join(r.choices(words, [9, 2, 5, 4, 2, 2, 2, 1, 1, 1, 1, 1])[0] + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(r.randint(0, 40)))
        out.append((r.choice(["en", "en", "de", None, "und"]), text))
    return [*out, out[-1], out[-1], ("en", "the of the " * 5000)]


@pytest.mark.parametrize("route_words,stretch", [(40, 64), (2_000_000, C.STRETCH)])
def test_counts_whatever_the_routes(spark, monkeypatch, route_words, stretch):
    rows = odd_rows()
    monkeypatch.setattr(C.stretches, "__defaults__", (stretch,))
    monkeypatch.setattr(C, "NOTICED", 2)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS lead", "'x' AS phrase", "2 AS f").repartition(3)
    every, words = C.phrases(docs, 3, route_words)
    assert {(r["lang"], r["phrase"]): r["f"] for r in every.collect()} == plain(rows, 3)
    n = collections.Counter()
    for (lang, phrase), f in plain(rows, 1).items():
        n[lang] += f if " " not in phrase else 0
    assert {r["lang"]: r["n"] for r in words.collect()} == {k: v for k, v in n.items() if v}


def test_result_equals_sql_on_odd_texts(spark, tmp_path):
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(odd_rows())], "doc_id long, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(C.ORACLE).fetchall()
    got = [tuple(r) for r in C.collocations(docs, route_words=500).collect()]
    assert want and sorted(got) == sorted(want)


def test_top_of_each_language(spark):
    docs = spark.createDataFrame([("en", f"w{i} x{i}. " * (10 + i % 3)) for i in range(30)], "lang string, text string")
    got = C.collocations(docs, top=7).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 8))
    assert all(r["score"] == 1_000_000 and r["a"] == 12 for r in got)


def test_empty_table(spark):
    assert not C.collocations(spark.createDataFrame([], "lang string, text string")).collect()


def test_products_beyond_64_bits(spark):
    assert spark.range(1).selectExpr("CAST(1000000 * CAST(5000000000 AS DECIMAL(16,0)) AS DECIMAL(22,0)) * CAST(5000000000 AS DECIMAL(16,0)) div (CAST(7000000001 AS DECIMAL(18,0)) * CAST(9000000011 AS DECIMAL(18,0))) AS s").first()["s"] == 1000000 * 5000000000**2 // (7000000001 * 9000000011)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_stretches_see_the_words_behind_them(size):
    rows = [(lang, text) for lang, text in odd_rows(5, 60) if text]
    f = collections.Counter()
    for lang, text in rows:
        for s in C.stretches(text.encode().translate(C.FOLD), size):
            for ids in zip(*(x.tolist() for x in s.next), strict=True):
                for k in range(1, 4):
                    if all(ids[:k]):
                        f[lang or "und", b" ".join(s.words[i - 1] for i in ids[:k]).decode()] += 1
    assert f == plain(rows, 1)
