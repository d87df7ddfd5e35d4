"""Words made to share a 64-bit hash get their own ids and counts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from thermaspark.llm import packing, rans, transducer
from thermaspark.llm.common import utf8
from thermaspark.llm.encode import Encoder
from thermaspark.llm.pieces import MIX_A, MIX_B, STEP, PieceTable, mix, range_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def unmix(h):
    """The inverse of pieces.mix."""
    undo = lambda h, k: h ^ (h >> np.uint64(k)) ^ (h >> np.uint64(2 * k))
    with np.errstate(over="ignore"):
        h = undo(h, 31) * np.uint64(pow(int(MIX_B), -1, 1 << 64))
        h = undo(h, 27) * np.uint64(pow(int(MIX_A), -1, 1 << 64))
    return undo(h, 30)


def colliding(word: str, seed: int = 0) -> str:
    """Another word of 16 letters with the hash of this one."""
    raw = np.frombuffer(word.encode(), np.uint8)
    goal = range_hashes(raw, np.array([0]), np.array([16]))
    r = np.random.default_rng(seed)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)
    while True:
        first = letters[r.integers(0, 52, (1 << 19, 8))]
        with np.errstate(over="ignore"):
            h = mix((mix(np.array([16], np.uint64) + STEP) ^ first.view("<u8")[:, 0]) + STEP)
            second = (unmix(goal) - STEP) ^ h
        rest = second.view(np.uint8).reshape(-1, 8)
        good = np.flatnonzero(np.isin(rest, letters).all(1))
        if len(good):
            return (first[good[0]].tobytes() + rest[good[0]].tobytes()).decode()


@pytest.fixture(scope="module")
def pairs():
    words = ["internationalize", "misunderstanding"]
    made = [(w, colliding(w, i)) for i, w in enumerate(words)] + [("internationalize", "yfrjrfpeZhNdBukS")]
    for a, b in made:
        raw = np.frombuffer((a + b).encode(), np.uint8)
        h = range_hashes(raw, np.array([0, 16]), np.array([16, 32]))
        assert a != b and h[0] == h[1]
    return made


def test_ids_and_counts_are_the_librarys(pairs):
    texts = [w for pair in pairs for w in pair] + [f"{a} {b}" for a, b in pairs] + [b for _, b in pairs]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    for order in (1, -1):
        ids, at = Encoder(PATH, 12).encode(*utf8(pa.array(texts[::order])))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want[::order]
        assert transducer.Counter(PATH).count(*utf8(pa.array(texts[::order]))).tolist() == [len(x) for x in want[::order]]


def test_a_full_table_starts_anew():
    seen = []
    table = PieceTable(4, lambda pieces, entries: seen.extend(pieces))
    for n in (3, 9, 40, 5, 200):
        words = [f"w{i}".encode() for i in range(n)] * 2
        raw, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
        found = table.entries(raw, np.append(0, ends[:-1]), ends)
        assert len(set(found.tolist())) == n and found[:n].tolist() == found[n:].tolist()


def test_states_that_outgrow_the_machine_within_a_word(monkeypatch):
    monkeypatch.setattr(transducer, "MOST_STATES", 40)
    text = "".join(chr(97 + (i * i) % 23) for i in range(3000))
    assert transducer.Counter(PATH).count(*utf8(pa.array([text, "short"]))).tolist() == [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in (text, "short")]


def test_queries(spark, pairs):
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(w for pair in pairs for w in pair)], "doc_id long, text string").coalesce(1)
    want = {r["doc_id"]: LIBRARY.encode(r["text"], add_special_tokens=False).ids for r in docs.collect()}
    crc = lambda ids: __import__("zlib").crc32(np.array(ids, "<u4").tobytes())
    assert {r["doc_id"]: r["n_tokens"] for r in transducer.token_counts(docs, PATH).collect()} == {k: len(v) for k, v in want.items()}
    assert {r["doc_id"]: r["ids_crc32"] for r in rans.read_ids(spark, rans.write_ids(docs, PATH)).collect()} == {k: crc([*v, 0]) for k, v in want.items()}
    assert {r["doc_id"]: r["ids_crc32"] for r in packing.pack(docs, PATH).collect()} == {k: crc([*v, 2]) for k, v in want.items()}
