"""Exact n-gram Jaccard join by set-relation skipping.

Documents with the same shingle set are one set. The join looks for sets that may link, in three steps that lose none:

1. Of every set of n the first n/5 + n/20 + 3 shingles by hash are indexed. Sets that link share so many of them that
   most sets, whose shingles are their own, drop out (`met`).
2. The shingles of those that are left are counted. A set of which fewer than 80 % occur in another one drops out, too.
   The others are ordered rarest first, and the first n/5 + 1 make the lists of the index.
3. Index-level skipping: lists are kept by position, in blocks that carry their bounds of size and position; blocks, and
   then rows, whose bounds leave too small an overlap are skipped. Answer-level skipping: a list's head, the set with the
   fewest rarer shingles, is the only one whose answers are computed from whole sets. What it joins into one component
   needs no answers of its own. Where a list still holds several components, the others' answers are derived from the
   head's: with D lacking from the head and A added to it, |x & y| = |head| - |Dx| - |Dy| + |Dx & Dy| + |Ax & Ay|, so that
   sets which do not both link with the head link only if they share differences. Only these are indexed, rarest first, and
   those that the same sets have as one block.

Defined results: a null or empty text has no shingles and links with nothing; every row counts as a document, so
repeated rows come back each, in one component if their texts are alike; a row with a null doc_id comes back, links
like any other and never names a component; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, bounded_batches, components, lean, staged, utf8
from .shingles import fingerprint, shingle_sets

#: Links: HUNDREDTHS * union <= 100 * intersection.
HUNDREDTHS = 80
#: Shingles of at least so many sets come last in the order, whatever their number.
COMMON = 64
#: Bytes of input for each part of the index, and the most parts.
PART_BYTES, MOST_PARTS = 2 << 20, 1 << 20
#: Records that a task gathers before it deals or reduces them; fingerprints that it remembers as dealt.
GATHERED, REMEMBERED = 1 << 18, 1_000_000
#: Keys of texts that may be broadcast, 8 bytes each; more are joined by a shuffle of the texts.
MOST_BROADCAST = 1_000_000
#: Positions in a block of a list.
BLOCK = 16
POSTINGS = "part int, postings binary"
PAIR = np.dtype([("h", "<u8"), ("fp", "<i8")])
RANKED = np.dtype([("fp", "<i8"), ("rank", "<u2"), ("h", "<u8")])
#: Stands for sets that a mapper has counted itself; fingerprints are never negative.
SEVERAL = -1


def missing(n, hundredths: int = HUNDREDTHS):
    """Shingles of a set of n that a set which links may lack. For numbers, arrays and, in SQL, columns' names."""
    return f"({n} - ({hundredths} * {n} + 99) div 100)" if isinstance(n, str) else n - (hundredths * n + 99) // 100


def slack(n):
    """Shingles that are indexed first beyond those."""
    return f"({n} div 20 + 3)" if isinstance(n, str) else n // 20 + 3


def least_met(n: str, hundredths: int) -> Column:
    """Of the first missing + slack shingles of a set of n, at least so many are met by a set that links."""
    return F.expr(f"greatest(1, least({slack(n)} - 1, {n} - {missing(n, hundredths)}))")


def overlap(n1: Column, n2: Column, hundredths: int) -> Column:
    """Shingles that sets of these sizes share if they link."""
    return F.ceil((n1 + n2) * hundredths / F.lit(100.0 + hundredths) - 1e-9)


def _own(docs: DataFrame) -> DataFrame:
    """doc_id, text and key, a hash that names the text."""
    text = F.col("text").cast("string").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).withColumn("key", F.xxhash64("text"))


def set_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, fp: the fingerprint of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(*utf8(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) for s in sets], pa.int64())], names=["doc_id", "key", "n_shingles", "fp"])

    return _own(docs).mapInArrow(lean(run), "doc_id long, key long, n_shingles long, fp long")


# -- parts of the index --------------------------------------------------------


def dealt(rows: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Rows packed by part."""
    order = np.argsort(part, kind="stable")
    rows, part = rows[order], part[order]
    which, first = np.unique(part, return_index=True)
    ends = np.append(first[1:], len(part))
    return pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array([rows[i:j].tobytes() for i, j in zip(first, ends, strict=True)], pa.binary())], names=["part", "postings"])


def by_part(packed: DataFrame, reducer: Callable[[int], object], schema: str) -> DataFrame:
    """reducer(part).add(blob) for all blobs of a part, then .end(); both yield batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one = None, None
        for b in batches:
            for part, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if part != now:
                    if one is not None:
                        yield from one.end()
                    now, one = part, reducer(part)
                yield from one.add(blob)
        if one is not None:
            yield from one.end()

    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(lean(run), schema)


def starts_of(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def in_order(held: list[np.ndarray], *fields: str) -> np.ndarray:
    """Records sorted by these fields, without repeats."""
    rec = np.concatenate(held)
    rec = rec[np.lexsort([rec[f] for f in reversed(fields)])]
    again = np.logical_and.reduce([rec[f][1:] == rec[f][:-1] for f in fields])
    return rec[np.append(True, ~again)] if len(rec) else rec


def is_in(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether, where) values are in the sorted `known`."""
    at = np.searchsorted(known, values)
    return (known[np.minimum(at, len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)), at


def spread(docs: DataFrame, parts: int, cut: Callable[[int], int] | None, enough: int, local: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Postings (h, fp) of all distinct sets, packed by part; of a set of n the first cut(n).

    Shingles of at least `enough` sets that a task has gathered are settled there: their own records go through the
    shuffle as local(h, fp), in parts below 0, and one record of SEVERAL stands for them in the index. So a shingle of
    very many sets is a few records for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        own, fps, size, turn = [], [], 0, TaskContext.get().partitionId()

        def deal() -> Iterator[pa.RecordBatch]:
            rec = np.zeros(size, PAIR)
            rec["h"], rec["fp"] = np.concatenate(own), np.repeat(np.array(fps, np.int64), [len(s) for s in own])
            rec = rec[np.argsort(rec["h"], kind="stable")]
            first = starts_of(rec["h"])
            many = np.diff(np.append(first, len(rec)))
            here = np.repeat(many >= enough, many)
            marks = rec[first[many >= enough]]
            marks["fp"] = SEVERAL
            out = np.concatenate([rec[~here], marks])
            yield dealt(out, out["h"] % np.uint64(parts))
            if here.any():
                mine = local(rec["h"][here], rec["fp"][here])
                yield pa.RecordBatch.from_arrays([pa.array([-1 - turn % parts], pa.int32()), pa.array([mine.tobytes()], pa.binary())], names=["part", "postings"])

        for b in batches:
            if len(known) > REMEMBERED:
                known.clear()
            for s in shingle_sets(*utf8(b.column(0))):
                f = fingerprint(s)
                if not len(s) or f in known:
                    continue
                known.add(f)
                own.append(s[: cut(len(s))].copy() if cut else s)  # not a view of the whole set
                fps.append(f)
                size += len(own[-1])
            if size >= max(GATHERED, 4 * parts):
                yield from deal()
                own, fps, size, turn = [], [], 0, turn + 7919
        if size:
            yield from deal()

    return docs.select("text").mapInArrow(lean(run), POSTINGS)


class Settled:
    """Takes what mappers have settled themselves."""

    def __init__(self, say: Callable[[bytes], pa.RecordBatch]):
        self.say = say

    def add(self, blob: bytes) -> Iterator[pa.RecordBatch]:
        yield self.say(blob)

    def end(self) -> Iterator[pa.RecordBatch]:
        return iter(())


# -- step 1: sets that meet others ---------------------------------------------


def counted(fps: np.ndarray) -> np.ndarray:
    """How often each set occurs, as pairs whose h is the number."""
    fp, k = np.unique(fps, return_counts=True)
    rec = np.zeros(len(fp), PAIR)
    rec["h"], rec["fp"] = k, fp
    return rec


def meetings(blob: bytes) -> pa.RecordBatch:
    rec = np.frombuffer(blob, PAIR)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rec["fp"])), pa.array(rec["h"].astype(np.int64))], names=["fp", "k"])


class Met:
    """For a part's postings, how many of each set's shingles another set has. Remembers one set for each shingle.

    A set that several tasks have dealt may be counted more than once: more sets stay then, none is lost.
    """

    def __init__(self, part: int):
        self.held, self.size = [], 0
        self.h, self.fp, self.shared = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, blob: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append(np.frombuffer(blob, PAIR))
        self.size += len(self.held[-1])
        if self.size >= GATHERED:
            yield from self.end()

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        rec = in_order(self.held, "h", "fp")
        self.held, self.size = [], 0
        first = starts_of(rec["h"])
        many = np.diff(np.append(first, len(rec)))
        h, fp = rec["h"][first], rec["fp"][first]
        shared = (many > 1) | (fp == SEVERAL)
        hit, at = is_in(h, self.h)
        old = at[hit]
        shared[hit] |= self.shared[old] | (self.fp[old] != fp[hit])
        now = old[shared[hit] & ~self.shared[old]]
        met = np.concatenate([rec["fp"][np.repeat(shared, many)], self.fp[now]])
        self.shared[now] = True
        self.h, self.fp, self.shared = (np.insert(a, at[~hit], b[~hit]) for a, b in ((self.h, h), (self.fp, fp), (self.shared, shared)))
        if (met >= 0).any():
            yield meetings(counted(met[met >= 0]).tobytes())


def survivors(docs: DataFrame, sizes: DataFrame, parts: int, hundredths: int) -> DataFrame:
    """(fp, n, key: a text with this set) of the sets whose first shingles other sets have."""
    packed = spread(docs, parts, lambda n: missing(n, hundredths) + slack(n), 2, lambda h, fp: counted(fp))
    met = by_part(packed, lambda part: Met(part) if part >= 0 else Settled(meetings), "fp long, k long").groupBy("fp").agg(F.sum("k").alias("k"))
    sets = sizes.filter("n_shingles > 0").groupBy("fp").agg(F.first("n_shingles").alias("n"), F.min("key").alias("key"))
    return sets.join(met, "fp").filter(F.col("k") >= least_met("n", hundredths)).select("fp", "n", "key")


# -- step 2: lists, rarest shingles first ------------------------------------------


def ranked(h: np.ndarray, fp: np.ndarray, rank: np.ndarray | int) -> np.ndarray:
    rec = np.zeros(len(h), RANKED)
    rec["fp"], rec["rank"], rec["h"] = fp, rank, h
    return rec


class Ranks:
    """For a part's postings, in how many sets each shingle is, up to COMMON; once it is in so many, its records go on at once."""

    def __init__(self, parts: int):
        self.parts, self.held, self.size, self.most = parts, [], 0, GATHERED
        self.common = np.zeros(0, np.uint64)

    def say(self, rec: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(rec):
            yield dealt(rec, rec["fp"] % self.parts)

    def add(self, blob: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append(np.frombuffer(blob, PAIR))
        self.size += len(self.held[-1])
        if self.size >= self.most:
            yield from self.reduce(last=False)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self.reduce(last=True)

    def reduce(self, last: bool) -> Iterator[pa.RecordBatch]:
        rec = in_order(self.held, "h", "fp")
        first = starts_of(rec["h"])
        many = np.diff(np.append(first, len(rec)))
        h, fp = rec["h"][first], rec["fp"][first]
        common = (many >= COMMON) | (fp == SEVERAL) | is_in(h, self.common)[0]
        self.common = np.union1d(self.common, h[common])
        of = np.repeat(common, many)
        yield from self.say(ranked(rec["h"][of & (rec["fp"] >= 0)], rec["fp"][of & (rec["fp"] >= 0)], COMMON))
        if last:
            rest = np.repeat(~common & (many > 1), many)
            yield from self.say(ranked(rec["h"][rest], rec["fp"][rest], np.repeat(many, many)[rest]))
        else:
            self.held = [rec[~of]]
            self.size = len(self.held[0])
            self.most = max(GATHERED, 2 * self.size)


class Prefixes:
    """Of each set of a part the first shingles, rarest first, if enough of all are shared. A set's size comes as rank 0."""

    def __init__(self, hundredths: int):
        self.hundredths, self.held = hundredths, []

    def add(self, blob: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append(np.frombuffer(blob, RANKED))
        return iter(())

    def end(self) -> Iterator[pa.RecordBatch]:
        rec = in_order(self.held, "fp", "rank", "h")
        self.held = []
        first = starts_of(rec["fp"])
        many = np.diff(np.append(first, len(rec)))
        n = rec["h"][first].astype(np.int64)
        lacking = missing(n, self.hundredths)
        alive = (rec["rank"][first] == 0) & (many - 1 >= n - lacking)
        nth = np.arange(len(rec)) - np.repeat(first, many)  # 1 for the first shared shingle
        pos = nth - 1 + np.repeat(n - (many - 1), many)
        keep = np.repeat(alive, many) & (nth > 0) & (pos <= np.repeat(lacking, many))
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(rec["h"][keep].view(np.int64)), pa.array(rec["fp"][keep]), pa.array(np.repeat(n, many)[keep], pa.int32()), pa.array(pos[keep], pa.int32())],
                names=["h", "fp", "n", "pos"],
            )


def index_lists(docs: DataFrame, alive: DataFrame, parts: int, hundredths: int) -> DataFrame:
    """(h, fp, n, pos): the lists of the index."""
    packed = spread(texts_of(docs, alive), parts, None, COMMON, lambda h, fp: ranked(h, fp, COMMON))

    def resend(blob: bytes) -> pa.RecordBatch:
        rec = np.frombuffer(blob, RANKED)
        return dealt(rec, rec["fp"] % parts)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                rec = ranked(b.column(1).to_numpy().astype(np.uint64), b.column(0).to_numpy(), 0)
                yield dealt(rec, rec["fp"] % parts)

    shared = by_part(packed, lambda part: Ranks(parts) if part >= 0 else Settled(resend), POSTINGS)
    both = shared.unionByName(alive.select("fp", "n").mapInArrow(lean(heads), POSTINGS))
    return by_part(both, lambda part: Prefixes(hundredths), "h long, fp long, n int, pos int")


# -- step 3: answers ---------------------------------------------------------------


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose text has one of keys(key)."""
    return docs.select("key", "text").join(bounded(keys.select("key").distinct(), MOST_BROADCAST), "key", "left_semi")


def set_of(docs: DataFrame, alive: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, own: the sorted hashes) of the sets in wanted(fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(*utf8(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["fp", "own"])

    keys = alive.join(wanted.select("fp").distinct(), "fp", "left_semi").select("key")
    # a text of many rows is one row before its set is made
    texts = texts_of(docs, keys).dropDuplicates(["key", "text"])
    return texts.select("text").mapInArrow(lean(run), "fp long, own binary").dropDuplicates(["fp"])


def common_of(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Whether each of s is in t; both sorted."""
    return t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s if len(t) else np.zeros(len(s), bool)


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(head, fp, ...) with n_head, n, lost, delta: how many of the head's shingles are lacking, and the hashes of these (complemented) and of those added, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, lost, delta = [], [], []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                head, own = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                gone, more = head[~common_of(head, own)], own[~common_of(own, head)]
                sizes.append((len(head), len(own)))
                lost.append(len(gone))
                delta.append(np.sort(np.concatenate([~gone, more])).tobytes())
            kinds = [b.column(0), b.column(1), *(pa.array([s[k] for s in sizes], pa.int32()) for k in (0, 1)), pa.array(lost, pa.int32()), pa.array(delta, pa.binary())]
            yield pa.RecordBatch.from_arrays(kinds, names=["head", "fp", "n_head", "n", "lost", "delta"])

    one, other = sets.select(F.col("fp").alias("head"), F.col("own").alias("own_head")), sets.select("fp", "own")
    both = pairs.select("head", "fp").join(other, "fp").join(one, "head").select("head", "fp", "own_head", "own")
    return both.mapInArrow(lean(run), "head long, fp long, n_head int, n int, lost int, delta binary")


def answers(deltas: DataFrame, hundredths: int) -> DataFrame:
    """The links (a, b) of heads."""
    both = F.col("n_head") - F.col("lost")
    return deltas.filter(both * (100 + hundredths) >= (F.col("n_head") + F.col("n")) * hundredths).select(F.col("head").alias("a"), F.col("fp").alias("b"))


def heads_of(lists: DataFrame) -> DataFrame:
    """(h, head, n_head, p_head): the set of a list with the fewest rarer shingles; lists of one set have no answers."""
    first = lists.groupBy("h").agg(F.min(F.struct("pos", F.negative("n").alias("n"), "fp")).alias("x"), F.count("*").alias("k")).filter("k > 1")
    return first.select("h", F.col("x.fp").alias("head"), (-F.col("x.n")).alias("n_head"), F.col("x.pos").alias("p_head"))


def skipped(lists: DataFrame, heads: DataFrame, hundredths: int) -> DataFrame:
    """The pairs (head, fp) of lists that sizes and positions allow to link: blocks first, then rows."""
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    blocks = lists.groupBy("h", block).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("near"))
    # before the shared shingle lie p_head shingles of the head, at most, that are in both; after it the rest of either set
    most = F.col("p_head") + F.least(F.col("n_head") - F.col("p_head"), F.col("high") - F.col("near"))
    fits = (F.col("high") * 100 >= F.col("n_head") * hundredths) & (F.col("low") * hundredths <= F.col("n_head") * 100) & (most >= overlap(F.col("n_head"), F.col("low"), hundredths))
    read = heads.join(blocks, "h").filter(fits).select("h", "block", "head", "n_head", "p_head")
    most = F.least("p_head", "pos") + F.least(F.col("n_head") - F.col("p_head"), F.col("n") - F.col("pos"))
    fits = (F.col("n") * 100 >= F.col("n_head") * hundredths) & (F.col("n") * hundredths <= F.col("n_head") * 100) & (most >= overlap(F.col("n_head"), F.col("n"), hundredths))
    return lists.withColumn("block", block).join(read, ["h", "block"]).filter(fits & (F.col("fp") != F.col("head"))).select("head", "fp").distinct()


#: What tells a block of differences from the others of its head: the number of its sets, and two sums of hashes of them.
BLOCK_ID = ("k", "one", "two")


def placed_blocks(rows: DataFrame) -> DataFrame:
    """rows(head, fp, ..., e) with the differences of a head that the same sets have, more than one of them, made one block; back: differences of the set from this block on.

    Blocks of few sets come first. A passage that sets lack or have added is one block, whatever its length, so that sets
    meet once for a passage and not for each of its shingles.
    """
    one, two = (F.expr(f"bit_xor(xxhash64(fp, '{secrets.token_hex(8)}'))").alias(n) for n in ("one", "two"))
    often = rows.groupBy("head", "e").agg(F.count("*").alias("k"), one, two).filter("k > 1")
    of_set = [c for c in rows.columns if c != "e"]
    blocks = rows.join(often, ["head", "e"]).groupBy(*of_set, *BLOCK_ID).agg(F.count("*").alias("w"))
    order = Window.partitionBy("head", "fp").orderBy(*BLOCK_ID).rowsBetween(0, Window.unboundedFollowing)
    # differences of one set come first and are not looked up
    return blocks.withColumn("back", F.sum("w").over(order)).drop("w")


def meeting(placed: DataFrame, hundredths: int) -> DataFrame:
    """Strays and sets of their head that meet in a block that may be the first they share.

    Sets of a head fall into classes of like size and like rest of the head. What two classes need to share at least
    cuts the blocks of either that are worth a look, before any sets meet.
    """
    steps = [F.floor(20 * F.col(c) / F.col("n_head")).cast("int").alias(n) for c, n in (("n", "size_class"), ("room", "room_class"))]
    classed = placed.select("*", *steps)
    each = classed.groupBy("head", "n_head", "size_class", "room_class").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("room").alias("most"))
    other = each.select("head", F.col("size_class").alias("y_size"), F.col("room_class").alias("y_rest"), *(F.col(c).alias(f"y_{c}") for c in ("low", "high", "most")))
    need = F.greatest(F.lit(1), overlap(F.col("low"), F.col("y_low"), hundredths) + F.col("n_head") - F.col("most") - F.col("y_most"))
    fits = (F.col("high") * 100 >= F.col("y_low") * hundredths) & (F.col("y_high") * 100 >= F.col("low") * hundredths)
    classes = each.join(other, "head").filter(fits).select("head", "size_class", "room_class", "y_size", "y_rest", need.cast("long").alias("need"))
    looked = classed.join(classes, ["head", "size_class", "room_class"]).filter("back >= need").drop("need")
    y = looked.select("head", *BLOCK_ID, F.col("size_class").alias("y_size"), F.col("room_class").alias("y_rest"), F.col("y_size").alias("size_class"), F.col("y_rest").alias("room_class"), *(F.col(c).alias(f"y_{c}") for c in ("fp", "room", "n", "back", "stray", "own")))
    return looked.filter("stray").join(y, ["head", *BLOCK_ID, "size_class", "room_class", "y_size", "y_rest"])


def places(deltas: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the differences to heads that some set of theirs is not joined with, their blocks)."""
    label = lambda c, name: labels.select(F.col("node").alias(c), F.col("component").alias(name))
    known = deltas.join(label("fp", "own"), "fp", "left").join(label("head", "of_head"), "head", "left")
    known = known.select("head", "fp", "n_head", "n", "lost", "delta", F.coalesce("own", "fp").alias("own"), F.coalesce("of_head", "head").alias("of_head"))
    stray = known.filter("own != of_head").select("head").distinct()
    known = staged(known.join(stray, "head", "left_semi"), "differences")

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [np.frombuffer(x.as_buffer(), "<i8") for x in b.column(6)]
            row = np.repeat(np.arange(len(b)), [len(x) for x in each])
            columns = [b.column(k).take(pa.array(row)) for k in range(6)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([np.zeros(0, np.int64), *each]))], names=["head", "fp", "room", "n", "size", "stray", "e"])

    # room: what is left of the head
    rows = known.select("head", "fp", (F.col("n_head") - F.col("lost")).alias("room"), "n", (F.octet_length("delta") / 8).cast("int").alias("size"), (F.col("own") != F.col("of_head")).alias("stray"), "delta")
    rows = staged(rows.mapInArrow(lean(single), "head long, fp long, room int, n int, size int, stray boolean, e long"), "elements")
    placed = staged(placed_blocks(rows).join(known.select("head", "fp", "n_head", "own"), ["head", "fp"]), "places")
    return known, placed


def derived(deltas: DataFrame, labels: DataFrame, hundredths: int) -> DataFrame:
    """Links (a, b) between sets of different components, from their differences to a head that they share.

    Where a and b do not both link with the head, |head| - |Da| - |Db| is below the overlap that they need (`lack`), so
    the first block of differences that they share has that many at or after it in both.
    """
    known, placed = places(deltas, labels)
    lack = overlap(F.col("n"), F.col("y_n"), hundredths) + F.col("n_head") - F.col("room") - F.col("y_room")
    sizes = (F.least("n", "y_n") * 100 >= F.greatest("n", "y_n") * hundredths) & (F.least("back", "y_back") >= lack)
    met = meeting(placed, hundredths).filter((F.col("own") != F.col("y_own")) & (~F.col("y_stray") | (F.col("fp") < F.col("y_fp"))) & sizes)
    pairs = met.groupBy(F.col("fp").alias("a"), F.col("y_fp").alias("b")).agg(F.min("head").alias("head"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_head, na, lost_a, nb, lost_b = (b.column(k).to_numpy().astype(np.int64) for k in (2, 3, 4, 6, 7))
            same = np.array([int(common_of(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")).sum()) for x, y in zip(b.column(5), b.column(8), strict=True)], np.int64)
            both = n_head - lost_a - lost_b + same
            kept = b.filter(pa.array(both * (100 + hundredths) >= (na + nb) * hundredths))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    one, other = (known.select("head", F.col("fp").alias(c), "n_head", F.col("n").alias(f"n{c}"), F.col("lost").alias(f"lost_{c}"), F.col("delta").alias(f"delta_{c}")) for c in "ab")
    whole = pairs.join(one, ["head", "a"]).join(other.drop("n_head"), ["head", "b"])
    return whole.select("a", "b", "n_head", "na", "lost_a", "delta_a", "nb", "lost_b", "delta_b").mapInArrow(lean(run), "a long, b long")


def set_links(docs: DataFrame, sizes: DataFrame, parts: int, hundredths: int) -> DataFrame:
    """Links (a, b) of sets that join all sets which link."""
    alive = staged(survivors(docs, sizes, parts, hundredths), "survivors")
    lists = staged(index_lists(docs, alive, parts, hundredths), "lists")
    heads = staged(heads_of(lists), "heads")
    pairs = staged(skipped(lists, heads, hundredths), "pairs")
    fps = lambda p: p.select("fp").union(p.select("head")).distinct()
    links = staged(answers(differences(pairs, staged(set_of(docs, alive, fps(pairs)), "sets")), hundredths), "links")
    labels = components(links)
    of = labels.select(F.col("node").alias("fp"), "component")
    known = lists.join(heads.select("h"), "h", "left_semi").join(of, "fp", "left").select("h", "fp", F.coalesce("component", "fp").alias("own"))
    mixed = known.groupBy("h").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low != high").select("h")
    left = staged(lists.join(heads.join(mixed, "h").select("h", "head"), "h").filter("fp != head").select("head", "fp").distinct(), "left")
    if not left.take(1):
        return links
    deltas = staged(differences(left, staged(set_of(docs, alive, fps(left)), "sets")), "deltas")
    return links.unionByName(derived(deltas, labels, hundredths))


def groups(docs: DataFrame, hundredths: int = HUNDREDTHS) -> DataFrame:
    """doc_id, key (xxhash64 of the text), n_shingles of all documents, and the component of their sets; null without shingles."""
    bounded_batches(docs.sparkSession)
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # of the files
    parts = 1024 if size >> 60 else min(max(64, size // PART_BYTES), MOST_PARTS)
    own = _own(docs)
    sizes = staged(set_sizes(docs), "sizes")
    labels = components(set_links(own, sizes, parts, hundredths)).select(F.col("node").alias("fp"), "component")
    named = sizes.join(labels, "fp", "left").select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "fp")).alias("component"))
    return staged(named, "groups")


def join(docs: DataFrame, hundredths: int = HUNDREDTHS) -> DataFrame:
    """doc_id, n_shingles, component_id of all documents."""
    named = groups(docs, hundredths)
    first = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("k")).filter("k > 1")
    out = named.join(first.select("component", "component_id"), "component", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, hundredths: int = HUNDREDTHS) -> DataFrame:
    """Of each component the row with the smallest doc_id, nulls last, and then the smallest hash of its text, once. Rows without shingles stay."""
    named = groups(docs, hundredths).filter("component is not null")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x"), F.count("*").alias("k")).filter("k > 1")
    others = named.join(first, "component").filter(~F.col("doc_id").eqNullSafe(F.col("x.doc_id")) | (F.col("key") != F.col("x.key")))
    again = named.groupBy("doc_id", "key").agg(F.count("*").alias("k")).filter("k > 1")
    row = F.col("doc_id").cast("long").eqNullSafe(F.col("__group_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__group_key"))
    named_so = lambda df: bounded(df.select(F.col("doc_id").alias("__group_id"), F.col("key").alias("__group_key")).distinct(), MOST_BROADCAST)
    kept, again = docs.join(named_so(others), row, "left_anti"), named_so(again)
    return kept.join(again, row, "left_anti").unionByName(kept.join(again, row, "left_semi").dropDuplicates(["doc_id", "text"]))
