"""SentencePiece ids of whole texts and back, with every distinct marked word segmented once per worker table.

No piece of the model has a whitespace marker behind another character, so merges never cross the place before a
marker: a text is cut there, each distinct word with its markers is segmented once by the library, and the ids are
joined by position. Words are looked up by their own characters, not by hashes. A model whose pieces do cross markers,
or that normalizes texts, gets whole texts instead. Decoding joins the texts of pieces; the library reads runs of bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, kept, lean

MARK = "▁"
#: Entries of a worker's table, the longest word that it keeps (longer ones are segmented each time), and characters handled at once.
ENTRIES, LONGEST, SLICE = 1 << 19, 256, 1 << 18
#: A marker, then (kept) further markers and the characters up to the next marker.
WORDS = re.compile(f"[ {MARK}]([ {MARK}]*[^ {MARK}]*)")
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6


def parts(text: str, size: int) -> Iterator[str]:
    """Pieces of about `size` characters, cut at a space behind another character; that space, a marker that every part begins with, is left out."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and text[cut - 1] in (" ", MARK):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def words_of(part: str) -> list[str]:
    """Marked words without their first marker."""
    if MARK in part or "  " in part or part[:1] == " ":
        return WORDS.findall(" " + part)
    return part.split(" ")


class Pieces:
    """encode(texts) and decode(ids) as the library gives them; distinct words are segmented once while the table has room."""

    def __init__(self, path: str, entries: int = ENTRIES, size: int = SLICE):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces
        whole = [p.piece for p in model.pieces if p.type in (NORMAL, USER_DEFINED, UNUSED)]
        crossing = any(MARK in p.lstrip(MARK) for p in whole) or MARK not in whole
        self.by_word = plain and not crossing and not model.trainer_spec.treat_whitespace_as_suffix and not model.denormalizer_spec.precompiled_charsmap
        kinds = np.array([p.type for p in model.pieces])
        self.known, self.byte = np.isin(kinds, (NORMAL, BYTE)), kinds == BYTE
        self.texts = [p.piece.replace(MARK, " ") for p in model.pieces]
        self.entries, self.size = entries, size
        # the library sets no marker before an empty text
        self.mark = np.array([self.library.piece_to_id(MARK)], np.int32).tobytes()
        self.table: dict[str, bytes] = {"": self.mark}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """A table that has all of these words: the worker's own, which starts anew when full, with long words beside it."""
        new = [w for w in set(words) if w not in self.table]
        if not new:
            return self.table
        found = self.library.encode(new, num_threads=1)
        raw, ends = np.fromiter(chain.from_iterable(found), np.int32).tobytes(), np.cumsum([4 * len(x) for x in found]).tolist()
        ids = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        short = {w: x for w, x in zip(new, ids, strict=True) if len(w) <= LONGEST}
        if len(self.table) + len(short) > self.entries:
            mine = {w: self.table[w] for w in set(words) if w in self.table} | dict(zip(new, ids, strict=True))
            self.table = {"": self.mark} | short if len(short) < self.entries else {"": self.mark}
            return mine
        self.table |= short
        return self.table if len(short) == len(new) else self.table | dict(zip(new, ids, strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(x, np.int32) for x in self.library.encode(texts, num_threads=1)]
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            table = self._learn(list(chain.from_iterable(words for _, words in waiting)))
            for i, words in waiting:
                out[i].append(b"".join(map(table.__getitem__, words)))
            waiting.clear()

        for i, text in enumerate(texts):
            for part in parts(text, self.size) if text else ():
                waiting.append((i, words_of(part)))
                held += len(part)
                if held >= self.size:
                    settle()
                    held = 0
        settle()
        return [np.frombuffer(b"".join(x), np.int32) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        if not self.by_word or ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all():
            return self.library.decode(ids.tolist())
        byte, text = self.byte[ids], []
        edges = [0, *(np.flatnonzero(byte[1:] != byte[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = ids[a:b].tolist()
            text.append(self.library.decode(own) if byte[a] else "".join(map(self.texts.__getitem__, own)))
        whole = "".join(text)
        return whole[1:] if not byte[0] and whole[0] == " " else whole


def pieces(path: str) -> Pieces:
    """One per worker process and file, until a task of another operator comes."""
    return kept(Pieces, path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids array<int> of every document, without begin and end ids.

    Defined results: a null or empty text has no ids; special strings inside a text are ordinary text; a text of any
    length is read whole; repeated rows come back each; an empty table gives no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = pieces(model)
            ids = known.encode([t or "" for t in b.column(1).to_pylist()])
            at = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(at), flat)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "doc_id long, ids array<int>")


def _rows(ids: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each row; null is none, and ids that are null count as unknown."""
    flat, at = ids.values.fill_null(0).to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        yield flat[a:b] if ids[i].is_valid else flat[:0]


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids; null ids give an empty text, ids that are null count as unknown ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = pieces(model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([known.decode(x) for x in _rows(b.column(1))], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(lean(run), "doc_id long, text string")


def digests(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids in decimals and of the text they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known, rows = pieces(model), list(_rows(b.column(1)))
            of_ids = [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in rows]
            of_text = [hashlib.sha256(known.decode(x).encode()).hexdigest() for x in rows]
            columns = [b.column(0), pa.array([len(x) for x in rows], pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
