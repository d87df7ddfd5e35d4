"""SentencePiece ids by words against the library on whole texts, and the query's cases."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from thermaspark.llm import catalogue, sentence_pieces

from ..conftest import DATA

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
BITS = ["a", " ", "  ", "▁", "\n", "é", "中", "\0", "the", " the", "<s>", "</s>", "<0x0A>", "😀", "ing", " .", "\t", "　", "１", "xyz"]
texts = st.lists(st.lists(st.sampled_from(BITS), max_size=25).map("".join) | st.text(max_size=30), min_size=1, max_size=8)


@pytest.fixture(scope="module", params=[(3, 1), (40, 9), (5000, 1 << 18)])
def pieces(request):
    return sentence_pieces.Pieces(PATH, *request.param)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_ids_and_texts_are_the_librarys(pieces, many):
    assert pieces.by_word
    for text, ids in zip(many, pieces.encode(many), strict=True):
        assert ids.tolist() == LIBRARY.encode(text)
        assert pieces.decode(ids) == LIBRARY.decode(ids.tolist())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3, 12, 13, 198, 170, 228, 230, 259, 264, 287, 300, 28705]) | st.integers(0, 31999), max_size=12))
def test_any_ids_decode_as_the_library_does(pieces, ids):
    assert pieces.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


def test_long_texts_and_words_outside_the_table(pieces):
    text = "word " * 3000 + "x" * 5000 + "  " * 40 + "é中" * 700
    assert pieces.encode([text, "", text])[2].tolist() == LIBRARY.encode(text)


def rows(text):
    ids = LIBRARY.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))


def test_null_empty_repeated_and_long_rows_clashing_columns(spark):
    data = [(1, None), (2, ""), (2, ""), (None, " a  b"), (3, "s" * 20000), (4, " ".join(str(i) for i in range(30000)))]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_tokens", "'x' AS ids_sha256")
    encoded = sentence_pieces.encode(docs, PATH)
    got = sorted(map(tuple, sentence_pieces.digests(encoded, PATH).collect()), key=str)
    assert got == sorted(((i, *rows(t)) for i, t in data), key=str)
    back = sorted(map(tuple, sentence_pieces.decode(encoded, PATH).collect()), key=str)
    assert back == sorted(((i, LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t in data), key=str)
    assert not sentence_pieces.digests(sentence_pieces.encode(docs.limit(0), PATH), PATH).collect()


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in catalogue.QUERIES["op12_sentence_pieces"](spark, DATA).collect()}
    assert got == {r["doc_id"]: rows(r["text"]) for r in docs}
