"""Token-id files: a static range asymmetric numeral system over interleaved blocks.

File format, all numbers little-endian. A file is a run of segments; a segment holds whole documents:

    magic "TIDS" | u32 header bytes | header | u32 crc32 of the header | block payloads
    header: u32 symbols, u32 ids, u32 documents, u32 blocks,
            zlib(u32 symbol * symbols, u16 (frequency - 1) * symbols)   -- the table all blocks share, u32 length before
            zlib(i64 doc_id, u8 null, u32 ids; each as an array)        -- u32 length before
            per block: u32 payload words, u32 crc32 of its payload, u32 crc32 of its ids (as u32), u32 checkpoints,
                       per checkpoint: u32 word position, u32 state * LANES

A block has BLOCK ids (the last one fewer), dealt over LANES interleaved states of 32 bits with 16-bit words. A
checkpoint every STEPS steps holds all states, so that parts of a block decode in parallel. Blocks are independent.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, open_fs, staged, utf8
from .encode import encoder

LANES, BLOCK, STEPS, SEGMENT = 256, 1 << 16, 128, 1 << 20
BITS = 16
MAGIC = b"TIDS"
SEGMENTS = "part int, segment int, path string, at long, size long, n_ids long, n_docs long"
DECODED = "doc_id long, start long, n_tokens long, ids_crc32 long"


def table_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that occur and their frequencies, which sum to 2^BITS; each at least 1."""
    symbols, counts = np.unique(ids, return_counts=True)
    freq = np.maximum(1, counts * (1 << BITS) // counts.sum())
    order = np.argsort(-freq, kind="stable")
    over = int(freq.sum()) - (1 << BITS)
    if over < 0:
        freq[order[0]] -= over
    while over > 0:  # take from the most frequent ones
        take = np.minimum(freq[order] - 1, np.maximum(1, over * freq[order] // freq.sum()))
        take = np.minimum(take, np.maximum(0, over - (np.cumsum(take) - take)))
        freq[order] -= take
        over -= int(take.sum())
    return symbols.astype("<u4"), freq.astype(np.int64)


def encode_blocks(index: np.ndarray, freq: np.ndarray) -> list[tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
    """(words, checkpoints) of each block; index: the ids as positions in the table."""
    start = np.cumsum(freq) - freq
    n = len(index)
    blocks = -(-n // BLOCK)
    wide = np.zeros(blocks * BLOCK, np.int64)
    wide[:n] = index
    wide = wide.reshape(blocks, BLOCK // LANES, LANES)
    steps = np.full(blocks, BLOCK // LANES)
    steps[-1] = -(-(n - (blocks - 1) * BLOCK) // LANES)
    f32, s32 = freq.astype(np.uint64), start.astype(np.uint64)
    x = np.full((blocks, LANES), 1 << 16, np.uint64)
    words: list[list[np.ndarray]] = [[] for _ in range(blocks)]
    marks: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(blocks)]
    count = np.zeros(blocks, np.int64)
    sixteen = np.uint64(16)
    for j in range(BLOCK // LANES - 1, -1, -1):
        live = blocks if j < steps[-1] else blocks - 1  # the last block may be shorter
        if not live:
            continue
        now = x[:live]
        f = f32[wide[:live, j]]
        emit = now >= (f << sixteen)
        low = (now & np.uint64(0xFFFF)).astype("<u2")
        per = emit.sum(axis=1)
        flat, at = low[emit], np.append(0, np.cumsum(per))
        for b in range(live):
            words[b].append(flat[at[b] : at[b + 1]])
        count[:live] += per
        now = np.where(emit, now >> sixteen, now)
        q = now // f
        x[:live] = (q << sixteen) + (now - q * f) + s32[wide[:live, j]]
        if j % STEPS == 0:
            for b in range(live):
                marks[b].append((int(count[b]), x[b].astype("<u4")))
    return [(np.concatenate(w[::-1]), [(int(c) - at, s) for at, s in m[::-1]]) for w, m, c in zip(words, marks, count, strict=True)]


def decode_units(words: np.ndarray, at: np.ndarray, states: np.ndarray, steps: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """Positions in the table, (unit, step, lane), of all units at once; a unit runs from one checkpoint to the next."""
    start = np.cumsum(freq) - freq
    symbol = np.repeat(np.arange(len(freq)), freq)
    f32, s32 = freq.astype(np.uint64), start.astype(np.uint64)
    order = np.argsort(-steps, kind="stable")
    x, pos, steps_o = states[order].astype(np.uint64), at[order].astype(np.int64), steps[order]
    out = np.zeros((len(at), int(steps.max()), states.shape[1]), np.int32)
    for j in range(int(steps.max())):
        live = int(np.searchsorted(-steps_o, -j, "left"))
        now = x[:live]
        slot = now & np.uint64(0xFFFF)
        s = symbol[slot.astype(np.int64)]
        out[:live, j] = s
        now = f32[s] * (now >> np.uint64(16)) + slot - s32[s]
        need = now < np.uint64(1 << 16)
        rank = np.cumsum(need, axis=1)
        where = (pos[:live, None] + rank - 1)[need]
        now[need] = (now[need] << np.uint64(16)) | words[where].astype(np.uint64)
        x[:live] = now
        pos[:live] += rank[:, -1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def pack_array(*arrays: np.ndarray) -> bytes:
    body = zlib.compress(b"".join(a.tobytes() for a in arrays), 1)
    return struct.pack("<I", len(body)) + body


def write_segment(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    symbols, freq = table_of(ids) if len(ids) else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
    lookup = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.int32)
    lookup[symbols] = np.arange(len(symbols))
    blocks = encode_blocks(lookup[ids], freq) if len(ids) else []
    head = [struct.pack("<IIII", len(symbols), len(ids), len(doc_ids), len(blocks)), pack_array(symbols, (freq - 1).astype("<u2"))]
    head.append(pack_array(np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], np.uint8), counts.astype("<u4")))
    body = []
    for b, (words, marks) in enumerate(blocks):
        payload = words.astype("<u2").tobytes()
        head.append(struct.pack("<IIII", len(words), zlib.crc32(payload), zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK].astype("<u4").tobytes()), len(marks)))
        head += [struct.pack("<I", at) + state.tobytes() for at, state in marks]
        body.append(payload)
    header = b"".join(head)
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, struct.pack("<I", zlib.crc32(header)), *body])


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, ids per document, ids); raises ValueError where a checksum differs."""
    if data[:4] != MAGIC:
        raise ValueError("no segment starts here")
    (size,) = struct.unpack_from("<I", data, 4)
    header, (crc,) = data[8 : 8 + size], struct.unpack_from("<I", data, 8 + size)
    if zlib.crc32(header) != crc:
        raise ValueError("damaged header")
    n_symbols, n, n_docs, n_blocks = struct.unpack_from("<IIII", header)
    at = 16

    def packed() -> bytes:
        nonlocal at
        (k,) = struct.unpack_from("<I", header, at)
        at += 4 + k
        return zlib.decompress(header[at - k : at])

    table, docs = packed(), packed()
    symbols = np.frombuffer(table, "<u4", n_symbols)
    freq = np.frombuffer(table, "<u2", n_symbols, 4 * n_symbols).astype(np.int64) + 1
    doc_ids, null = np.frombuffer(docs, "<i8", n_docs).tolist(), np.frombuffer(docs, np.uint8, n_docs, 8 * n_docs)
    counts = np.frombuffer(docs, "<u4", n_docs, 9 * n_docs).astype(np.int64)
    names = [None if z else d for d, z in zip(doc_ids, null, strict=True)]
    if not n_blocks:
        return names, counts, np.zeros(0, "<u4")
    crcs, starts, states, steps, place, payload = [], [], [], [], 12 + size, 12 + size
    for b in range(n_blocks):
        n_words, crc_words, crc_ids, n_marks = struct.unpack_from("<IIII", header, at)
        at += 16
        if zlib.crc32(memoryview(data)[place : place + 2 * n_words]) != crc_words:
            raise ValueError(f"damaged payload of block {b}")
        total = -(-min(BLOCK, n - b * BLOCK) // LANES)
        for m in range(n_marks):
            (word,) = struct.unpack_from("<I", header, at)
            states.append(np.frombuffer(header, "<u4", LANES, at + 4))
            starts.append((place - payload) // 2 + word)
            steps.append(min(STEPS, total - m * STEPS))
            at += 4 + 4 * LANES
        crcs.append((crc_ids, n_marks))
        place += 2 * n_words
    words = np.frombuffer(data, "<u2", (place - payload) // 2, payload)
    found = decode_units(words, np.array(starts), np.array(states), np.array(steps), freq)
    out, unit = [], 0
    for b, (crc_ids, n_marks) in enumerate(crcs):
        index = np.concatenate([found[u, : steps[u]].reshape(-1) for u in range(unit, unit + n_marks)])[: min(BLOCK, n - b * BLOCK)]
        ids = symbols[index]
        if zlib.crc32(ids.tobytes()) != crc_ids:
            raise ValueError(f"damaged ids of block {b}")
        out.append(ids)
        unit += n_marks
    return names, counts, np.concatenate(out)


# -- the jobs -------------------------------------------------------------------


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Encodes all documents into files in ascending doc_id order (nulls first); one row per segment written.

    A task writes one file under a name of its own attempt; only attempts whose rows were kept count. So a task
    that runs again, or twice, leaves at most a file that nothing refers to.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = fresh(spark, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tids"
        names: list[int | None] = []
        counts: list[np.ndarray] = []
        held: list[np.ndarray] = []
        rows, at, out = [], 0, None

        def flush() -> None:
            nonlocal at, out, names, counts, held
            n = np.concatenate(counts)
            ids = np.concatenate(held)
            data = write_segment(names, n, ids)
            if out is None:
                files, place = open_fs(path)
                files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                out = files.open_output_stream(place)
            out.write(data)
            rows.append((part, len(rows), path, at, len(data), len(ids), len(names)))
            at += len(data)
            names, counts, held = [], [], []

        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            ids, cut = encoder(tokenizer).encode(raw, offsets)
            ids = np.insert(ids.astype("<u4"), cut[1:], end_id)
            n = np.diff(cut) + 1
            ends = np.cumsum(n)
            doc_ids, i = batch.column(0).to_pylist(), 0
            while i < len(n):
                room = SEGMENT - sum(len(h) for h in held)
                before = ends[i] - n[i]
                j = max(i + 1, int(np.searchsorted(ends, before + room, "right")))
                names += doc_ids[i:j]
                counts.append(n[i:j])
                held.append(ids[before : ends[j - 1]])
                i = j
                if i < len(n):
                    flush()
        if names:
            flush()
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "segment", "path", "at", "size", "n_ids", "n_docs"), r, strict=True)) for r in rows], schema=pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("at", "size", "n_ids", "n_docs"))]))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    dealt = own.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    return staged(dealt.mapInArrow(run, SEGMENTS), "segments")


def placed_segments(segments: DataFrame) -> DataFrame:
    """Segments with `first`, the ids in all segments before. Sums per file first, so that the one-task window sees a row per file."""
    files = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = files.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")
    return segments.withColumn("inside", inside).join(before, "part").withColumn("first", F.col("before") + F.col("inside")).select("path", "at", "size", "first")


def read_ids(spark: SparkSession, segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document read back from the files: doc_id, start, n_tokens, ids_crc32, and ids if asked for."""
    schema = DECODED + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                files, place = open_fs(r["path"])
                with files.open_input_file(place) as f:
                    f.seek(r["at"])
                    names, counts, ids = read_segment(f.read(r["size"]))
                ends = np.cumsum(counts)
                view, bounds = memoryview(ids.astype("<u4").view(np.uint8)), np.append(0, ends).tolist()
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [pa.array(names, pa.int64()), pa.array(r["first"] + ends - counts), pa.array(counts), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return placed_segments(segments).repartition(tasks).mapInArrow(run, schema)
