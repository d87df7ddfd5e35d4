"""Token ids of whole texts by the tokenizers library, with every distinct piece of text encoded once per worker.

Byte-level BPE files with the usual split pattern cut a text in places that its neighbours alone decide
(pieces.safe_cuts). So a text's ids are the ids of its pieces, one after another. A worker keeps the ids of pieces
in a bounded table, where a piece is found by hash and known by its bytes; the library encodes those that are new.
A text with a special string goes to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .common import kept
from .pieces import PieceTable, gather, grown, safe_cuts

#: Slots (2^n) of a worker's table, about 40 MB with its pieces and ids; bytes handled at once.
TABLE_BITS, CALL_BYTES = 20, 1 << 20
WORD = re.compile(" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ])+")


def byte_values() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies and the bytes they stand for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """encode(raw, offsets): ids of all texts one after another and the n+1 offsets of texts in them."""

    def __init__(self, path: str, bits: int = TABLE_BITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        largest = max(self.library.get_vocab(with_added_tokens=True).values())
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.shown = {b: c for c, b in byte_values().items()}
        self.table = PieceTable(bits, self._learn, self._forget)

    def _forget(self) -> None:
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int32)
        self.pool, self.used = np.empty(0, self.kind), 0

    def _library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _piece(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if WORD.fullmatch(text):  # one word of the split pattern: straight to the library's merges
            return [t.id for t in self.library.model.tokenize(raw.decode("latin-1").translate(self.shown))]
        return self._library(text)

    def _learn(self, pieces: list[bytes], entries: np.ndarray) -> None:
        """Ids of new pieces."""
        ids = [self._piece(p) for p in pieces]
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((i for x in ids for i in x), self.kind, int(lengths.sum()))
        self.starts, self.lengths = grown(self.starts, int(entries[-1]) + 1), grown(self.lengths, int(entries[-1]) + 1)
        self.pool = grown(self.pool, self.used + len(flat))
        self.starts[entries] = self.used + np.cumsum(lengths) - lengths
        self.lengths[entries] = lengths
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _few(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = safe_cuts(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        entries = self.table.entries(raw, starts, ends)
        lengths = self.lengths[entries].astype(np.int64)
        ids = self.pool[gather(self.starts[entries], lengths)]
        before = np.append(0, np.cumsum(lengths))
        return ids, before[np.searchsorted(starts, offsets, "left")]

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        i, n = 0, len(offsets) - 1
        data = raw.tobytes() if any(s in memoryview(raw).tobytes() for s in self.specials) else b""
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CALL_BYTES, "right")) - 1)
            part = raw[offsets[i] : offsets[j]]
            if data and any(s in data[offsets[i] : offsets[j]] for s in self.specials):
                for k in range(i, j):
                    text = data[offsets[k] : offsets[k + 1]]
                    if any(s in text for s in self.specials):
                        one = np.array(self._library(text.decode()), self.kind)
                    else:
                        one = self._few(raw[offsets[k] : offsets[k + 1]], np.array([0, len(text)]))[0] if text else np.zeros(0, self.kind)
                    ids.append(one)
                    counts.append(np.array([len(one)]))
            elif len(part):
                some, at = self._few(part, offsets[i : j + 1] - offsets[i])
                ids.append(some)
                counts.append(np.diff(at))
            else:
                counts.append(np.zeros(j - i, np.int64))
            i = j
        flat = np.concatenate(ids) if ids else np.zeros(0, self.kind)
        return flat, np.append(0, np.cumsum(np.concatenate(counts))) if counts else np.zeros(1, np.int64)


def encoder(path: str) -> Encoder:
    """One per worker process and file, until a task of another operator comes."""
    return kept(Encoder, path)
