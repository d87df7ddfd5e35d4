"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Every word is given to the network as two inputs: an embedding of the word and the mean of the embeddings of its
character trigrams, both through hashed tables. The network reads windows of WINDOW words that overlap by half, all
of a text's windows; a text's score is that of its worst window, calibrated on documents.

It is trained on the driver from a bounded sample of labelled documents (SAMPLE per class, the first by a hash of
their ids). Labels are of documents, so training is in two rounds: first every window has its document's label, then
the windows of toxic documents that the first round finds innocent are left out.

Defined results: a null, empty or blank text scores 0; a document with conflicting labels counts as toxic; without
labels of both classes every score is the share of toxic labels; repeated rows are scored each; a null doc_id is
kept and held out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back, lean, utf8
from .pieces import HashTable, gather
from .shingles import LOWER, WHITE, words

WINDOW, STRIDE = 24, 12
#: Labelled documents per class that training may see, and windows per class and round.
SAMPLE, TRAIN_WINDOWS = 1500, 8_000
#: Words and trigrams in fewer documents of the sample have no embedding of their own.
LEAST_DOCUMENTS = 5
#: Weight of a clean document in the calibration; the sample has as many of both classes.
CLEAN_WEIGHT = 6.0
#: Share of clean training windows that are turned into a repeated word.
JUNK = 0.1
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 8, 12, 8
CHAR_BITS = 15
#: Slots of a worker's table of projected words, words looked up at once, and windows run in step.
TABLE_BITS, RUN_WORDS, STEP_WINDOWS = 18, 1 << 16, 1024
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


# -- inputs -----------------------------------------------------------------


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after, words before each text)."""
    h, starts, at = words(raw, offsets)
    solid = np.append(~WHITE[raw], False)
    stop = np.flatnonzero(~solid)
    ends = stop[np.searchsorted(stop, starts)] if len(starts) else starts
    if len(starts):
        text_end = offsets[np.searchsorted(at, np.arange(len(starts)), "right")]
        ends = np.minimum(ends, text_end)
    return h, starts, ends, at


def in_parts(raw: np.ndarray, offsets: np.ndarray, most: int = 1 << 18) -> tuple[np.ndarray, ...]:
    """word_bounds() of many texts in bounded memory: a few texts at a time."""
    found, before, i = [], 0, 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        h, starts, ends, at = word_bounds(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        found.append((h, starts + offsets[i], ends + offsets[i], at[:-1] + before))
        before, i = before + len(h), j
    parts = [np.concatenate(x) for x in zip(*found, strict=True)]
    return parts[0], parts[1], parts[2], np.append(parts[3], before)


def trigram_rows(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character table for all trigrams of the words with a mark at both ends, and how many each word has."""
    raw = LOWER[raw]
    n = ends - starts
    at = gather(starts, n)
    first = np.cumsum(n) - n
    code = raw[at].astype(np.int64)
    before, after = np.empty_like(code), np.empty_like(code)
    before[1:], after[:-1] = code[:-1], code[1:]
    before[first] = 256
    after[first + n - 1] = 257
    mixed = ((before * 263 + code) * 263 + after) * 0x9E3779B1
    return (mixed >> 7) & ((1 << CHAR_BITS) - 1), n


def windows_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each window, its text); the last window of a text ends with it."""
    n = np.diff(at)
    many = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(n)), many)
    i = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return at[text] + np.minimum(i * STRIDE, np.maximum(0, n[text] - WINDOW)), text


# -- the network -----------------------------------------------------------------


def new_weights(rng: np.random.Generator, known: np.ndarray, trigrams: np.ndarray) -> dict[str, np.ndarray]:
    d = WORD_DIM + CHAR_DIM
    small = lambda *shape, s=0.1: (rng.standard_normal(shape) * s).astype(np.float32)
    w = {"words": known, "trigrams": trigrams, "word": np.zeros((len(known) + 1, WORD_DIM), np.float32), "char": np.zeros((1 << CHAR_BITS, CHAR_DIM), np.float32)}
    for side in ("f", "b"):
        w |= {f"W{side}": small(d, 3 * HIDDEN, s=d**-0.5), f"U{side}": small(HIDDEN, 3 * HIDDEN, s=HIDDEN**-0.5), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
    return w | {"A": small(2 * HIDDEN, ATTEND, s=0.3), "v": small(ATTEND, s=0.3), "u": small(2 * HIDDEN, s=0.3), "o": np.zeros(1, np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run_side(x: np.ndarray, mask: np.ndarray, U: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction, (step, window, HIDDEN), from projected inputs (step, window, 3 HIDDEN)."""
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    out = np.empty((len(x), x.shape[1], HIDDEN), np.float32)
    for t in range(len(x)):
        gates = sigmoid(x[t, :, : 2 * HIDDEN] + h @ U[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        rh = r * h
        n = np.tanh(x[t, :, 2 * HIDDEN :] + rh @ U[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t], new, h)
        if keep is not None:
            keep.append((h, z, r, rh, n))
        h = out[t] = new
    return out


def forward(xf: np.ndarray, xb: np.ndarray, mask: np.ndarray | None, w: dict, keep: dict | None = None) -> np.ndarray:
    """Logits of windows. mask: (step, window, 1), where there is a word; None if everywhere."""
    steps: dict[str, list | None] = {"f": [] if keep is not None else None, "b": [] if keep is not None else None}
    hf = run_side(xf, mask, w["Uf"], steps["f"])
    hb = run_side(xb[::-1], None if mask is None else mask[::-1], w["Ub"], steps["b"])[::-1]
    H = np.concatenate([hf, hb], axis=2)
    T = np.tanh(H @ w["A"])
    e = T @ w["v"]
    if mask is not None:
        e = np.where(mask[:, :, 0], e, -1e9)
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tn,tnd->nd", a, H)
    if keep is not None:
        keep |= {"H": H, "T": T, "a": a, "pooled": pooled, **steps}
    return pooled @ w["u"] + w["o"][0]


def side_gradients(dH: np.ndarray, steps: list, mask: np.ndarray, U: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(of the projected inputs, of U)."""
    dx, dU, dh = np.empty((len(steps), dH.shape[1], 3 * HIDDEN), np.float32), np.zeros_like(U), np.zeros_like(dH[0])
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, rh, n = steps[t]
        dh = dh + dH[t]
        d, m = dh * mask[t], dh * ~mask[t]
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        drh = dn @ U[:, 2 * HIDDEN :].T
        dr = drh * h * r * (1 - r)
        g = np.concatenate([dz, dr], axis=1)
        dU[:, : 2 * HIDDEN] += h.T @ g
        dU[:, 2 * HIDDEN :] += rh.T @ dn
        dx[t, :, : 2 * HIDDEN], dx[t, :, 2 * HIDDEN :] = g, dn
        dh = d * z + drh * r + g @ U[:, : 2 * HIDDEN].T + m
    return dx, dU


class Vocabulary:
    """The distinct words of a sample: rows of the word table (0: unknown) and of the character table."""

    def __init__(self, raw: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.keys, first, self.of = np.unique(h, return_index=True, return_inverse=True)
        self.char, self.n = trigram_rows(raw, starts[first], ends[first])
        self.at = np.cumsum(self.n) - self.n

    def inputs(self, ids: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray]:
        rows = self.char[gather(self.at[ids], self.n[ids])]
        first = np.cumsum(self.n[ids]) - self.n[ids]
        mean = np.add.reduceat(w["char"][rows], first) / self.n[ids][:, None]
        return np.concatenate([w["word"][self.word_rows(ids, w)], mean.astype(np.float32)], axis=1), rows

    def word_rows(self, ids: np.ndarray, w: dict) -> np.ndarray:
        if not len(w["words"]):
            return np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(w["words"], self.keys[ids]), len(w["words"]) - 1)
        return np.where(w["words"][at] == self.keys[ids], at + 1, 0)


def train(texts: list[str], toxic: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights, with the calibration of documents as `scale` and `shift`."""
    rng = np.random.default_rng(seed)
    rate = float(toxic.mean()) if len(toxic) else 0.0
    if len(set(toxic.tolist())) < 2:
        w = new_weights(rng, np.zeros(0, np.uint64), np.zeros(1 << CHAR_BITS, bool))
        return w | {"scale": np.zeros(1), "shift": np.array([np.log(max(rate, 1e-9) / max(1 - rate, 1e-9))])}
    raw, offsets = utf8(pa.array(texts, pa.string()))
    h, starts, ends, at = in_parts(raw, offsets)
    vocabulary = Vocabulary(raw, h, starts, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    word_doc = np.unique(vocabulary.of * len(texts) + doc)
    seen = np.bincount(word_doc // len(texts), minlength=len(vocabulary.n))
    n_tri = vocabulary.n[word_doc // len(texts)]
    tri_doc = np.unique(vocabulary.char[gather(vocabulary.at[word_doc // len(texts)], n_tri)] * len(texts) + np.repeat(word_doc % len(texts), n_tri))
    usual = np.bincount(tri_doc // len(texts), minlength=1 << CHAR_BITS) >= LEAST_DOCUMENTS
    w = new_weights(rng, vocabulary.keys[seen >= LEAST_DOCUMENTS], usual)
    first, text = windows_of(at)
    n = np.minimum(np.diff(at)[text], WINDOW)
    fit = rng.random(len(texts)) < 0.7  # the others calibrate
    label = toxic[text].astype(np.float32)

    def batch(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(WINDOW)[:, None]
        mask = step < n[ids]
        return vocabulary.of[np.minimum(first[ids] + step, len(h) - 1)], mask

    def logits(ids: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(ids), STEP_WINDOWS):
            word, mask = batch(ids[k : k + STEP_WINDOWS])
            some, back = np.unique(word, return_inverse=True)
            x = vocabulary.inputs(some, w)[0]
            back = back.reshape(word.shape)
            out.append(forward((x @ w["Wf"] + w["cf"])[back], (x @ w["Wb"] + w["cb"])[back], mask[:, :, None], w))
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items() if v.dtype == np.float32}
    count = 0

    def step(ids: np.ndarray, rate: float) -> None:
        nonlocal count
        count += 1
        word, mask = batch(ids)
        # some clean windows become one of their words over and over, as in junk
        junk = np.flatnonzero((label[ids] == 0) & (rng.random(len(ids)) < JUNK))
        word[:, junk] = word[rng.integers(0, n[ids[junk]]), junk]
        some, back = np.unique(word, return_inverse=True)
        back = back.reshape(word.shape)
        x, rows = vocabulary.inputs(some, w)
        kept: dict = {}
        m3 = mask[:, :, None]
        y = forward((x @ w["Wf"] + w["cf"])[back], (x @ w["Wb"] + w["cb"])[back], m3, w, kept)
        dy = ((sigmoid(y) - label[ids]) / len(ids)).astype(np.float32)
        g = {"u": kept["pooled"].T @ dy, "o": np.array([dy.sum()], np.float32)}
        dp = dy[:, None] * w["u"]
        H, a, T = kept["H"], kept["a"], kept["T"]
        da = np.einsum("tnd,nd->tn", H, dp)
        de = a * (da - (a * da).sum(axis=0))
        dT = de[:, :, None] * w["v"] * (1 - T * T)
        g["v"], g["A"] = np.einsum("tn,tnk->k", de, T), np.einsum("tnd,tnk->dk", H, dT)
        dH = a[:, :, None] * dp + dT @ w["A"].T
        dxf, g["Uf"] = side_gradients(dH[:, :, :HIDDEN], kept["f"], m3, w["Uf"])
        dxb, g["Ub"] = side_gradients(dH[::-1, :, HIDDEN:], kept["b"], m3[::-1], w["Ub"])
        dxb = dxb[::-1]
        dx = np.zeros_like(x)
        for side, d in (("f", dxf), ("b", dxb)):
            own = np.zeros((len(some), 3 * HIDDEN), np.float32)
            np.add.at(own, back.reshape(-1), d.reshape(-1, 3 * HIDDEN))
            g[f"W{side}"], g[f"c{side}"] = x.T @ own, own.sum(axis=0)
            dx += own @ w[f"W{side}"].T
        g["word"], g["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
        np.add.at(g["word"], vocabulary.word_rows(some, w), dx[:, :WORD_DIM])
        g["word"][0] = 0
        per = dx[:, WORD_DIM:] / vocabulary.n[some][:, None]
        np.add.at(g["char"], rows, np.repeat(per, vocabulary.n[some], axis=0))
        g["char"][~w["trigrams"]] = 0
        for k, d in g.items():
            m, v = moments[k]
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            w[k] -= (rate * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-8)).astype(np.float32)

    def rounds(ids: np.ndarray, times: int, rate: float) -> None:
        for _ in range(times):
            pick = np.concatenate([rng.permutation(ids[label[ids] == c])[:TRAIN_WINDOWS] for c in (0, 1)])
            order = rng.permutation(pick)
            for k in range(0, len(order), 512):
                step(order[k : k + 512], rate)

    every = np.arange(len(first))
    own = every[fit[text]]
    rounds(own, 3, 0.02)
    y = logits(every)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, y)
    clean_high = np.quantile(top[(toxic == 0) & np.isfinite(top)], 0.9)
    guilty = own[((label == 0) | (y >= np.minimum(clean_high, top[text])))[own]]
    hard = guilty[np.argsort(-np.where(label[guilty] == 0, y[guilty], 0))[: TRAIN_WINDOWS // 2]]
    rounds(np.unique(np.concatenate([hard, rng.permutation(guilty[label[guilty] == 0])[: TRAIN_WINDOWS // 2], guilty[label[guilty] == 1]])), 3, 0.01)
    rounds(guilty, 3, 0.003)
    y = logits(every)
    top = np.full(len(texts), -20.0)
    np.maximum.at(top, text, y)
    scale, shift = 1.0, 0.0
    if len(set(toxic[~fit].tolist())) == 2:
        top, toxic = top[~fit], toxic[~fit]
    # the cut with the least weighted error, in the middle of its gap; clean documents are the larger part of a corpus
    order = np.argsort(top)
    wrong = CLEAN_WEIGHT * (toxic == 0).sum() + np.append(0, np.cumsum(np.where(toxic[order] == 1, 1.0, -CLEAN_WEIGHT)))
    edges = np.concatenate([[top.min() - 1], top[order], [top.max() + 1]])
    gap = np.diff(edges)
    best = np.flatnonzero(wrong == wrong.min())
    k = best[np.argmax(gap[best])]
    cut = edges[k] + gap[k] / 2
    scale = 3 / max(1e-3, float(np.median(top[toxic == 1])) - cut)
    shift = -scale * cut
    return w | {"scale": np.array([max(scale, 0.05)]), "shift": np.array([shift])}


# -- scoring --------------------------------------------------------------------


class Scorer:
    """Scores batches of texts; keeps the projected inputs of words it has seen in a bounded table."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w
        self.clear()
        self.rows = np.zeros((self.table.room, 6 * HIDDEN), np.float32)  # all at once: no copies while it fills

    def clear(self) -> None:
        self.table = HashTable(TABLE_BITS)

    def entries(self, raw: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of words, good until the next call; the caller gives no more words than the table has room for."""
        found = self.table.find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            keys, first, inverse = np.unique(h[new], return_index=True, return_inverse=True)
            if self.table.size + len(keys) > self.table.room:
                self.clear()
                return self.entries(raw, h, starts, ends)
            at = new[first]
            v = Vocabulary(raw, keys, starts[at], ends[at])
            x = v.inputs(np.arange(len(keys)), self.w)[0]
            entry = np.arange(self.table.size, self.table.size + len(keys), dtype=np.int32)
            self.rows[entry, : 3 * HIDDEN] = x @ self.w["Wf"] + self.w["cf"]
            self.rows[entry, 3 * HIDDEN :] = x @ self.w["Wb"] + self.w["cb"]
            self.table.add(keys, entry)
            found[new] = entry[inverse]
        return found

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) == 1:
            return np.zeros(0)
        h, starts, ends, at = in_parts(raw, offsets)
        first, text = windows_of(at)
        n = np.minimum(np.diff(at)[text], WINDOW)
        top = np.full(len(offsets) - 1, -np.inf)
        i = 0
        while i < len(first):
            # windows whose words fit into an empty table, however long the text; at least one
            j = max(i + 1, int(np.searchsorted(first + n, first[i] + min(RUN_WORDS, self.table.room), "right")))
            own = slice(first[i], first[j - 1] + n[j - 1])
            y = self.logits(self.entries(raw, h[own], starts[own], ends[own]), first[i:j] - first[i], n[i:j])
            np.maximum.at(top, text[i:j], y)
            i = j
        out = 1 / (1 + np.exp(-np.clip(self.w["scale"][0] * np.where(np.isfinite(top), top, 0) + self.w["shift"][0], -30, 30)))
        return np.where(np.isfinite(top), out, 0.0)

    def logits(self, entries: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of windows of n words from `first` on; entries: rows of the words."""
        out = np.empty(len(first), np.float32)
        step = np.arange(WINDOW)[:, None]
        order = np.argsort(n < WINDOW, kind="stable")
        full = int((n == WINDOW).sum())
        cuts = [*range(0, full, STEP_WINDOWS), *range(full, len(order), STEP_WINDOWS), len(order)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            k = order[a:b]
            mask = None if b <= full else (step < n[k])[:, :, None]
            x = self.rows[entries[np.minimum(first[k] + step, len(entries) - 1)]]
            out[k] = forward(x[:, :, : 3 * HIDDEN], x[:, :, 3 * HIDDEN :], mask, self.w)
        return out


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list[str], np.ndarray]:
    """A bounded sample of labelled documents that are not held out; whole texts. Of rows that share a doc_id, one text."""
    known = labels.filter("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("doc_id")))
    first = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    picked = first[0].unionByName(first[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.int64)


def score(docs: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    bounded_batches(docs.sparkSession)
    give_back()  # what training took

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for b in batches:
            raw, offsets = utf8(b.column(1))
            s = scorer.scores(raw, offsets)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return own.mapInArrow(lean(run), SCHEMA)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, train(*training_rows(docs, labels, sample)))


def keep_clean(docs: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """docs without those whose score is 0.5 or more."""
    bounded_batches(docs.sparkSession)
    give_back()
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for b in batches:
            yield b.filter(pa.array(scorer.scores(*utf8(b.column(at).cast(pa.string()))) < 0.5))

    return docs.mapInArrow(lean(run), docs.schema)
