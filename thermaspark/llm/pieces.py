"""Texts as bytes in numpy: safe cuts, 64-bit hashes of byte ranges and a table from such hashes to arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Masks of the first i of eight bytes.
LANES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: Longer ranges are hashed one at a time.
LONG = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Finishes 64-bit values; a bijection."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * MIX_A
        h = (h ^ (h >> np.uint64(27))) * MIX_B
        return h ^ (h >> np.uint64(31))


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes, never 0, of byte ranges. Eight bytes at a time are mixed into the hash so far, all ranges in step."""
    size = ends - starts
    lanes = np.ndarray((len(raw) + 1,), "<u8", np.append(raw, np.zeros(8, np.uint8)), strides=(1,))
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) + STEP)
        live, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
        while len(live):
            left = size[live] - at
            h[live] = mix((h[live] ^ (lanes[starts[live] + at] & LANES[np.minimum(left, 8)])) + STEP)
            live, at = live[left > 8], at + 8
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    h[h == 0] = 1
    return h


# -- safe cuts ----------------------------------------------------------------

_B = np.arange(256)
_ASCII_SOLID = (_B > 32) & (_B < 127)
_LETTER = ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122))
_PUNCT = _ASCII_SOLID & ~_LETTER & ~((_B >= 48) & (_B <= 57))
#: Lead bytes of characters that are surely no white space.
_SOLID_LEAD = _ASCII_SOLID | ((_B >= 0xC3) & (_B <= 0xDF)) | ((_B >= 0xE4) & (_B <= 0xF4))
_LATIN_TAIL = (_B >= 0x80) & (_B <= 0xBF) & (_B != 0x97) & (_B != 0xB7)


def safe_cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted starts of pieces: every text's start, and places where byte-level split patterns cut in any context.

    These are: before a space between two solid characters; before and after a lone line feed between such; and
    between a letter and ASCII punctuation. Solid and letter are only ASCII or Latin letters written as C3 xx, so
    that a place which would need a Unicode table is simply not cut.
    """
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        latin = np.zeros(n, bool)
        latin[1:] = (raw[:-1] == 0xC3) & _LATIN_TAIL[raw[1:]]
        letter = _LETTER[raw] | latin
        solid = _ASCII_SOLID[raw] | latin
        lead = _SOLID_LEAD[raw]
        gap = (raw[1:-1] == 32) | (raw[1:-1] == 10)
        alone = gap & solid[:-2] & lead[2:]
        cut[1 : n - 1] |= alone
        cut[2:n] |= alone & (raw[1:-1] == 10)
        cut[1:n] |= letter[:-1] & _PUNCT[raw[1:]]
    cut[offsets[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


def equal_ranges(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ranges of these sizes hold the same bytes in a and in b; eight bytes of all at a time."""
    view = lambda x: np.ndarray((len(x) + 1,), "<u8", np.append(x, np.zeros(8, np.uint8)), strides=(1,))
    la, lb = view(a), view(b)
    same = np.ones(len(sizes), bool)
    live, at = np.flatnonzero((sizes > 0) & (sizes <= LONG)), 0
    while len(live):
        left = sizes[live] - at
        same[live] &= ((la[a_starts[live] + at] ^ lb[b_starts[live] + at]) & LANES[np.minimum(left, 8)]) == 0
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(sizes > LONG).tolist():
        same[i] = np.array_equal(a[a_starts[i] : a_starts[i] + sizes[i]], b[b_starts[i] : b_starts[i] + sizes[i]])
    return same


class HashTable:
    """Maps 64-bit keys (never 0) to entry numbers; open addressing in numpy, bounded."""

    def __init__(self, bits: int):
        self.bits, self.size, self.room = bits, 0, int(0.7 * (1 << bits))
        self.keys, self.entry = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry numbers, or -1."""
        out = np.full(len(h), -1, np.int32)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        got = self.keys[slot]
        hit = got == h
        out[hit] = self.entry[slot[hit]]
        left = np.flatnonzero(~hit & (got != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            got = self.keys[slot[left]]
            hit = got == h[left]
            out[left[hit]] = self.entry[slot[left[hit]]]
            left = left[~hit & (got != 0)]
        return out

    def add(self, h: np.ndarray, entries: np.ndarray) -> None:
        """Distinct new keys; the caller minds `room`."""
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.entry[slot[put]] = h[put], entries[put]
            left = left[self.keys[slot[left]] != h[left]]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
        self.size += len(h)


def grown(a: np.ndarray, n: int) -> np.ndarray:
    """a with room for n values at least; what is new is not touched yet."""
    if n <= len(a):
        return a
    out = np.empty(max(n, len(a) + len(a) // 2, 1 << 16), a.dtype)
    out[: len(a)] = a
    return out


class PieceTable:
    """Numbers of distinct pieces of text, found by hash and told apart by their bytes; starts anew when full.

    learn(pieces, entries) is called with the bytes of new pieces and their numbers, forget() when the table starts anew.
    """

    #: Most pieces whose hash belongs to another piece.
    ODD = 1 << 16

    def __init__(self, bits: int, learn: Callable[[list[bytes], np.ndarray], None], forget: Callable[[], None] = lambda: None):
        self.bits, self.learn, self.forget = bits, learn, forget
        self.clear()

    def clear(self) -> None:
        self.table, self.odd, self.n = HashTable(self.bits), {}, 0
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int32)
        self.pool, self.used = np.empty(0, np.uint8), 0
        self.forget()

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        entries = np.arange(self.n, self.n + len(pieces), dtype=np.int32)
        sizes, flat = np.array([len(p) for p in pieces], np.int64), np.frombuffer(b"".join(pieces), np.uint8)
        self.starts, self.sizes = grown(self.starts, self.n + len(pieces)), grown(self.sizes, self.n + len(pieces))
        self.pool = grown(self.pool, self.used + len(flat))
        self.starts[entries], self.sizes[entries] = self.used + np.cumsum(sizes) - sizes, sizes
        self.pool[self.used : self.used + len(flat)] = flat
        self.used, self.n = self.used + len(flat), self.n + len(pieces)
        self.learn(pieces, entries)
        return entries

    def entries(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of the pieces raw[start:end]."""
        if len(self.odd) > self.ODD:
            self.clear()
        h = range_hashes(raw, starts, ends)
        entries = self.table.find(h)
        new = np.flatnonzero(entries < 0)
        if len(new):
            keys, first, inverse = np.unique(h[new], return_index=True, return_inverse=True)
            if self.table.size and self.table.size + len(keys) > self.table.room:
                self.clear()
                return self.entries(raw, starts, ends)
            while len(keys) > self.table.room:
                self.table = HashTable(self.table.bits + 1)
            data = raw.tobytes()
            found = self._add([data[starts[i] : ends[i]] for i in new[first].tolist()])
            self.table.add(keys, found)
            entries[new] = found[inverse]
        sizes = ends - starts
        fits = self.sizes[entries] == sizes
        fits[fits] = equal_ranges(raw, starts[fits], self.pool, self.starts[entries[fits]], sizes[fits])
        for i in np.flatnonzero(~fits).tolist():  # another piece has this hash
            piece = raw[starts[i] : ends[i]].tobytes()
            if piece not in self.odd:
                self.odd[piece] = int(self._add([piece])[0])
            entries[i] = self.odd[piece]
        return entries


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start..start+length-1 of all ranges, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
