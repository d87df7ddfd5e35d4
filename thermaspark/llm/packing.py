"""Best-fit packing of documents into training sequences by bin completion with branch and bound.

Only a histogram of piece lengths (at most `capacity` numbers) reaches the driver. There, bin completion fills one
sequence around the longest piece left and uses that filling as often as the histogram allows; the last few pieces
are packed by branch and bound over undominated fillings, best fit of what is left being the incumbent throughout. The plan, a bounded list of ranges of ranks per length, goes back to the tasks,
which place every piece by its rank among the pieces of its length.

Defined results: a null or empty text is the end id alone; a null doc_id is kept; repeated rows are packed each;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, lean, staged, utf8
from .encode import encoder

CAPACITY, END_ID = 1024, 2
#: Search nodes per filling and for the last pieces; beyond them the best found so far stands.
FILL_NODES, BOUND_NODES, LAST_PIECES = 3000, 3000, 80
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


# -- the search -------------------------------------------------------------


def fillings(counts: np.ndarray, room: int, nodes: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of fillings of `room` that nothing more can be put behind, longest lengths first, in descending order."""
    sizes = np.flatnonzero(counts[: room + 1]).tolist()
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, len(sizes) - 1, ())]
    while stack and nodes:
        nodes -= 1
        rest, at, chosen = stack.pop()
        usable = [i for i in range(min(at, bisect_right(sizes, rest) - 1), -1, -1) if sizes[i] and counts[sizes[i]] > chosen.count(sizes[i])]
        if not usable:
            yield rest, chosen
        stack += [(rest - sizes[i], i, (*chosen, sizes[i])) for i in reversed(usable)]


def dominated(filling: tuple[int, ...], waste: int, unused: int) -> bool:
    """Whether some of the filling's pieces, or none, could give way to one unused piece that is longer and fits, or as long and in the place of several.

    Every packing with the filling can then be changed into one with the other filling and no more sequences.
    `unused` has a bit for each length of which a piece is left.
    """
    some, several = 1, 0  # sums of any number of pieces, of two or more
    for u in filling:
        several |= several << u | (some & ~1) << u
        some |= some << u
    longer, reach = some << 1 if waste else 0, 1  # what exceeds a sum by 1 to waste
    while reach < waste:
        step = min(reach, waste - reach)
        longer |= longer << step
        reach += step
    return bool((longer | several) & unused)


def completions(counts: np.ndarray, room: int, nodes: int) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of the undominated fillings of `room`, the least waste first."""
    have = sum(1 << u for u in np.flatnonzero(counts).tolist())
    out = []
    for waste, filling in fillings(counts, room, nodes):
        used = sum(1 << u for u in set(filling) if filling.count(u) == counts[u])
        if not dominated(filling, waste, have & ~used & ~1):
            out.append((waste, filling))
    return sorted(out, key=lambda x: x[0])


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, the incumbent of the search: fillings and how often each is used.

    The tightest sequence that takes a piece is tighter still behind it, so it takes pieces of this length while they fit.
    """
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {capacity: [((), 1 << 62)]}
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            room = min(r for r in open_at if r >= size)
            filling, times = open_at[room].pop()
            each = room // size
            full = min(times, left // each)
            moves = [(each, full)] if full else [(left, 1)]
            for pieces, n in moves:
                open_at.setdefault(room - pieces * size, []).append((filling + (size,) * pieces, n))
                times, left = times - n, left - pieces * n
            if times:
                open_at[room].append((filling, times))
            if not open_at[room]:
                del open_at[room]
    return [(f, n) for fs in open_at.values() for f, n in fs if f]


def used(found: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(n for _, n in found)


def bounded_search(counts: np.ndarray, capacity: int, nodes: int = BOUND_NODES) -> list[tuple[int, ...]]:
    """Bin completion: branches over the undominated fillings around the longest piece, least waste first; waste bounds prune."""
    best = [f for f, n in best_fit(counts, capacity) for _ in range(n)]
    sizes = np.arange(len(counts))
    total = int((counts * sizes).sum())
    least = -(-total // capacity)
    left = [nodes]
    seen: dict[bytes, int] = {}

    def go(now: np.ndarray, done: list[tuple[int, ...]], waste: int) -> None:
        nonlocal best
        if len(best) == least or left[0] <= 0:
            return
        left[0] -= 1
        rest = int((now * sizes).sum())
        if not rest:
            if len(done) < len(best):
                best = list(done)
            return
        if len(done) + -(-rest // capacity) >= len(best) or seen.get(key := now.tobytes(), len(best)) <= len(done):
            return
        seen[key] = len(done)
        if len(seen) > 50_000:
            seen.clear()
        incumbent = [f for f, n in best_fit(now, capacity) for _ in range(n)]
        if len(done) + len(incumbent) < len(best):
            best = [*done, *incumbent]
        top = int(np.flatnonzero(now)[-1])
        now = now.copy()
        now[top] -= 1
        for lost, f in completions(now, capacity - top, FILL_NODES):
            if total + waste + lost > (len(best) - 1) * capacity:
                break
            after = now.copy()
            np.subtract.at(after, list(f), 1)
            go(after, [*done, (top, *f)], waste + lost)

    if len(best) > least:
        go(counts.copy(), [], 0)
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and how often each is used; together they hold the histogram's pieces exactly.

    A filling of least waste around the longest piece is used as often as its pieces allow, until the last pieces go to
    the bounded search. Best fit of all that is left, at the start and at every halving, stands where it needs no more.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    out: list[tuple[tuple[int, ...], int]] = []
    if counts[capacity]:
        out.append(((capacity,), int(counts[capacity])))
        counts[capacity] = 0
    best, again = [*out, *best_fit(counts, capacity)], counts.sum() // 2
    least = used(out) + -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    while counts.sum() > LAST_PIECES and used(best) > least:
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        filling = (top, *tightest(counts, capacity - top, FILL_NODES))
        counts[top] += 1
        kinds, per = np.unique(filling, return_counts=True)
        times = int((counts[kinds] // per).min())
        counts[kinds] -= per * times
        out.append((filling, times))
        if counts.sum() <= again:
            again = counts.sum() // 2
            best = min(best, [*out, *best_fit(counts, capacity)], key=used)
    if used(best) > least:
        best = min(best, [*out, *((f, 1) for f in bounded_search(counts, capacity))], key=used)
    return best


def tightest(counts: np.ndarray, room: int, nodes: int) -> tuple[int, ...]:
    """A filling of least waste, as far as so many nodes go."""
    best = (room + 1, ())
    for waste, filling in fillings(counts, room, nodes):
        best = min(best, (waste, filling), key=lambda x: x[0])
        if not waste:
            break
    return best[1]


def ranges(found: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """The plan by length and rank: keys (length << 40 | first rank), first rank, first sequence, pieces per sequence, index into the offsets, offsets."""
    rows, offsets, next_rank, base = [], [], {}, 0
    for filling, times in found:
        at: dict[int, list[int]] = {}
        for size, place in zip(filling, np.cumsum([0, *filling[:-1]]).tolist(), strict=True):
            at.setdefault(size, []).append(place)
        for size, places in at.items():
            first = next_rank.get(size, 0)
            rows.append((size << 40 | first, first, base, len(places), len(offsets)))
            offsets += places
            next_rank[size] = first + times * len(places)
        base += times
    rows.sort()
    return (*np.array(rows or [(0, 0, 0, 1, 0)], np.int64).T, np.array(offsets or [0], np.int64))


# -- the job ----------------------------------------------------------------


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every document: the first may be shorter, the others have `capacity` ids. nth counts a task's pieces of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            ids, at = encoder(tokenizer).encode(raw, offsets)
            n = np.diff(at) + 1
            many = -(-n // capacity)
            first = n - (many - 1) * capacity
            doc = np.repeat(np.arange(len(n)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            length = np.where(piece == 0, first[doc], capacity)
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            wide = np.insert(ids.astype("<u4"), at[1:], end_id).astype("<u4")
            begin = (at[:-1] + np.arange(len(n)))[doc] + start
            view = memoryview(wide.view(np.uint8))
            sums = [zlib.crc32(view[4 * a : 4 * (a + b)]) for a, b in zip(begin.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(doc), np.int64)
            sizes, starts, per = np.unique(length[order], return_index=True, return_counts=True)
            nth[order] = np.arange(len(doc)) - np.repeat(starts, per) + seen[length[order]]
            seen[sizes] += per
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(np.full(len(doc), part), pa.int32()), pa.array(nth)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence and place it goes."""
    bounded_batches(docs.sparkSession)
    cut = staged(cut_documents(docs, tokenizer, capacity, end_id), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    keys, first, base, per, index, offsets = ranges(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            k = np.searchsorted(keys, length << 40 | rank, "right") - 1
            local = rank - first[k]
            sequence, offset = base[k] + local // per[k], offsets[index[k] + local % per[k]]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    return ranked.mapInArrow(lean(place), PLACED)


def sequences(placed: DataFrame) -> DataFrame:
    """The pieces of every sequence in order: sequence_id, parts array<struct<offset, doc_id, piece, start, length>>. At most capacity parts a sequence."""
    part = F.struct("offset", "doc_id", "piece", "start", "length")
    return placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
