"""Sets of word shingles as sorted 64-bit hashes, computed from the bytes of whole batches."""

from __future__ import annotations

import hashlib

import numpy as np

from .pieces import mix, range_hashes

WIDTH = 5
_B = np.arange(256)
WHITE = (_B == 32) | ((_B >= 9) & (_B <= 13))
LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
WEIGHTS = np.random.default_rng(7).integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first byte, words before each text, n+1): runs of bytes that are no white space, A-Z lower-cased."""
    raw = LOWER[raw]
    n = len(raw)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~WHITE[raw]
    bound = np.zeros(n + 1, bool)
    bound[offsets] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | bound))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | bound))
    starts = starts[starts < n]
    return range_hashes(raw, starts, ends), starts, np.searchsorted(starts, offsets, "left")


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, ascending. A text of fewer words has one shingle; one without words none."""
    h, _, at = words(raw, offsets)
    sums = np.zeros(max(0, len(h) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            sums += h[j : j + len(sums)] * WEIGHTS[j]
    sums = mix(sums)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(sums[a : b - width + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif b > a:
            with np.errstate(over="ignore"):
                out.append(mix(np.array([(h[a:b] * WEIGHTS[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(own: np.ndarray) -> int:
    """63 bits of a set."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little") >> 1
