"""The queries of this subpackage and their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat, collocations, decontaminate, jaccard, near_vectors, packing, prefix_trie, rans, secret_scan, sentence_pieces, toxicity, transducer, warc
from .common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.read_ids(spark, rans.write_ids(table(spark, sf_dir, "documents"), TOKENIZER))


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


ORACLES["op2_secret_scan"] = secret_scan.oracle()


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op4_decontamination"] = decontaminate.ORACLE


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


ORACLES["op8_warc"] = warc.ORACLE


@query
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_and_digest(table(spark, sf_dir, "conversations"))


ORACLES["op10_chat_format"] = chat.ORACLE


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = collocations.ORACLE


@query
def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(sentence_pieces.encode(table(spark, sf_dir, "documents"), PIECES), PIECES)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op13_prefix_trie"] = prefix_trie.ORACLE


QUERIES["pipeline"] = corpus_pipeline.run
