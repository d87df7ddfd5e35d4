"""Parts without Spark: encoder, transducer, file codec, archives, templates, packing search, shingles."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from thermaspark.llm import chat, common, near_vectors, packing, pieces, rans, secret_scan, shingles, transducer, warc
from thermaspark.llm.common import utf8
from thermaspark.llm.encode import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BITS = ["a", " ", "  ", "\n", "\t", "'s", " 'll", "é", "1", "9 ", "!", "<|endoftext|>", " x", "　", "\x1c", "😀", "ab", "×", "\xa0", " .", "ing", "tion", " the", "aaaa", "==", ".\n"]
texts = st.lists(st.lists(st.sampled_from(BITS), max_size=25).map("".join) | st.text(max_size=30), min_size=1, max_size=20)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, 12)


@pytest.fixture(scope="module")
def counter():
    return transducer.Counter(PATH)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_encoder_equals_library(encoder, many):
    ids, at = encoder.encode(*utf8(pa.array([*many, None], pa.string())))
    for text, a, b in zip([*many, ""], at[:-1], at[1:], strict=True):
        assert ids[a:b].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(texts)
def test_transducer_equals_library(counter, many):
    got = counter.count(*utf8(pa.array([*many, None], pa.string())))
    assert got.tolist() == [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in [*many, ""]]


def test_chunk_maps_compose(counter, monkeypatch):
    monkeypatch.setattr(transducer, "CHUNK", 5)
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(BITS) for _ in range(30))
        assert counter.long_text(text.encode()) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_chunk_maps_are_associative(counter):
    a, b, c = (counter.chunk_map(x) for x in (b"the ques", b"tion is he", b"re. And now"))
    left, right = counter.compose(counter.compose(a, b), c), counter.compose(a, counter.compose(b, c))
    assert left == right and counter.scan([a, b, c]) == len(LIBRARY.encode("the question is here. And now", add_special_tokens=False).ids)


@pytest.mark.parametrize("size", [1, 7, 8, 9, 16, 40, pieces.LONG, pieces.LONG + 1])
def test_hashes_depend_on_bytes_alone(size):
    word = np.random.default_rng(size).integers(0, 256, size).astype(np.uint8)
    seen, others = set(), set()
    for at in (0, 5, 1000):
        raw = np.concatenate([np.full(at, 120, np.uint8), word, np.full(at % 7, 9, np.uint8)])
        seen.add(int(pieces.range_hashes(raw, np.array([at]), np.array([at + size]))[0]))
        others |= {int(h) for h in pieces.range_hashes(np.append(raw, 0), np.array([at, at]), np.array([at + size + 1, at + size - 1]))}
    assert len(seen) == 1 and not seen & others


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, rans.BLOCK - 1, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK + 77])
@pytest.mark.parametrize("kinds", [1, 3, 50_000])
def test_ans_round_trip(n, kinds):
    ids = np.random.default_rng(n + kinds).integers(0, kinds, n).astype("<u4")
    names, counts, back = rans.read_segment(rans.write_segment([None, 7], np.array([n // 2, n - n // 2]), ids))
    assert names == [None, 7] and counts.sum() == n and np.array_equal(back, ids)


def test_ans_finds_damage():
    data = bytearray(rans.write_segment([1], np.array([5000]), np.arange(5000, dtype="<u4") % 900))
    for at in (20, len(data) - 5):
        bad = data.copy()
        bad[at] ^= 1
        with pytest.raises((ValueError, zlib.error)):
            rans.read_segment(bytes(bad))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", "<s>", ""]), st.lists(st.sampled_from([*chat.CONTROLS, "\\", "x", "\n", "[", "<", " [/INST]", "/s>"]), max_size=8).map("".join)), max_size=6))
def test_chat_round_trip_and_spans(turns):
    out, found, rewritten = chat.spans(chat.template, turns)
    assert chat.turns_of(out) == turns and not rewritten
    for (_, text), (a, b, s, e) in zip(turns, found, strict=True):
        assert a <= s <= e <= b and chat.unescape(out[s:e]) == text


def test_template_that_rewrites_history_is_reported():
    def render(turns):
        return f"{len(turns)} turns: " + "".join(f"<{t}>" for _, t in turns)

    assert chat.spans(render, [("user", "a"), ("assistant", "b")])[2] == [0, 1]


def test_archive_members_and_damage():
    payload = b"<html>" + b"x" * 2000
    sha1 = __import__("hashlib").sha1(payload).hexdigest()
    data = b"".join(warc.member(warc.record(i, "http://a b/", payload, None if i else 5, sha1)) for i in (0, 1))
    got = [warc.parse(m) for m in warc.members(io.BytesIO(data))]
    assert [g[0]["warc-type"] for g in got] == ["revisit", "response"] and got[1][2] == payload
    with pytest.raises(warc.DamagedArchive):
        list(warc.members(io.BytesIO(data[:-3])))
    with pytest.raises(warc.DamagedArchive):
        warc.parse(warc.record(1, None, payload, None, sha1).replace(b"xxx", b"xyx", 1))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40))
def test_plan_holds_every_piece_once(sizes):
    histogram = {s: sizes.count(s) for s in sizes}
    found = packing.plan(histogram, 64)
    back = {}
    for filling, times in found:
        assert sum(filling) <= 64
        for s in filling:
            back[s] = back.get(s, 0) + times
    assert back == histogram
    assert sum(t for _, t in found) >= -(-sum(sizes) // 64)


def test_bounded_search_finds_the_optimum():
    counts = np.zeros(11, np.int64)
    for s in (6, 6, 4, 4, 5, 5, 3, 3, 2, 2):
        counts[s] += 1
    assert len(packing.bounded_search(counts, 10)) == 4


def test_required_trigrams():
    q = secret_scan.required_trigrams
    assert q("AKIA[A-Z0-9]+") == ("and", (("tri", "aki"), ("tri", "kia")))
    assert q("[0-9a-f]+") is None
    assert secret_scan.trigrams(q("(foobar|barfoo)x")) == {"foo", "oob", "oba", "bar", "arx", "arf", "rfo", "oox"}
    assert q("(abc|d)") is None and q("ab?c") is None


def test_shingles_of_short_and_odd_texts():
    got = shingles.shingle_sets(*utf8(pa.array([None, "", " \t", "A b c", "a B c", "a b c d e", "a b c d e f a b c d e", "a\xa0b c d e"], pa.string())))
    assert [len(s) for s in got] == [0, 0, 0, 1, 1, 1, 7 - 1, 1]
    assert got[3][0] == got[4][0] != got[5][0] != got[7][0]


def test_bucket_counts_links_once():
    x = np.array([[1.0, 0], [0.99, 0.05], [0, 1.0]])
    rows = np.zeros(3, [("label", "<i8"), ("dim", "<i4"), ("side", "<i4"), ("tab", "<i4"), ("cls", "<i8"), ("copies", "<i8")])
    rows["cls"], rows["copies"] = [1, 2, 3], [4, 1, 1]
    codes = np.array([[5, 1], [5, 1], [5, 2]], np.uint64)
    links, forest = near_vectors.bucket_links(rows, x, codes, 0.93)
    assert links.tolist() == [1, 4, 0] and forest == [(0, 1)]
    rows["tab"] = 1  # they met in the table before
    links, forest = near_vectors.bucket_links(rows, x, codes, 0.93)
    assert links.tolist() == [0, 0, 0] and not forest


def test_a_worker_keeps_the_object_of_one_operator():
    one = common.kept(list, "a")
    assert common.kept(list, "a") is one
    assert common.kept(list, "b") == ["b"] and common.kept(list, "a") is not one
    assert list(common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    assert not common._kept
