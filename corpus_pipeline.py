"""A training corpus from raw documents: toxic ones go, one of each group of near copies stays, leaked benchmark items go, secrets are masked, the rest is packed.

Each stage takes what the one before kept, as Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from thermaspark.llm import decontaminate, jaccard, packing, secret_scan, toxicity
from thermaspark.llm.common import staged, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled part of `docs`, scores below 0.5."""
    weights = toxicity.train(*toxicity.training_rows(docs, table(spark, sf_dir, "labels"), toxicity.SAMPLE))
    return toxicity.keep_clean(docs, weights)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id, nulls last, and then the smallest hash of its text, once. Rows without words stay."""
    return jaccard.one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item, whatever their doc_id; null and empty texts stay."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts replaced by [SECRET]; null texts stay null."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences; a null or empty text is its end id alone, and repeated rows are packed each."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", without_leaks),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]
#: Scoring by a network can't be put in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
