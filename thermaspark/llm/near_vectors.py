"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables, reranked with the vectors.

A rotation is learned on a bounded sample of vectors so that the signs of the rotated coordinates are balanced binary
codes close to the vectors. Codes are cut into substrings, one hash table each; vectors of one label that agree in a
substring are candidates, and their cosine in double precision decides. The length of substrings follows from the size
of the largest label, so that buckets stay small; the number of tables follows from that length and from RECALL, the
share of pairs at the threshold that is to be met. Where one code has too few substrings, rotations learned from other
starts give more.

Equal vectors of a label are one class and are never paired. A bucket's pairs are counted in the first table in which
they meet, so that links are sums over buckets and no pair leaves its task but those of a spanning forest. Buckets
beyond BLOCK classes are dealt over several tasks by pairs of blocks; none is cut.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those without label,
link with nothing; vectors of different lengths are not compared; repeated rows are vectors of their own; a null
vec_id is kept and names no component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, components, lean, staged

COSINE, RECALL, SAMPLE, ROUNDS, BITS, BLOCK = 0.93, 0.97, 4096, 40, 64, 1024
#: Bits of a substring at least, and vectors that a bucket of the largest label has in the mean at most.
LEAST_WIDTH, BUCKET = 8, 64
INDEXED = "label long, dim int, tab int, value long, cls long, codes binary, copies long, vector binary"
FOUND = "cls long, other long, links long"


def width_for(vectors: int) -> int:
    """Bits of a substring for a label of so many vectors."""
    return max(LEAST_WIDTH, math.ceil(math.log2(max(1, vectors) / BUCKET)))


def tables_for(width: int, cosine: float) -> int:
    """A bit of vectors at the threshold differs with a probability of their angle / pi; enough tables for RECALL of them to meet."""
    agree = (1 - math.acos(cosine) / math.pi) ** width
    return math.ceil(math.log(1 - RECALL) / math.log(1 - agree)) if 0 < agree < 1 else 1


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rotation(sample: np.ndarray, start: int = 0) -> np.ndarray:
    """(dim, bits): principal directions, then the rotation that brings their signs closest to the vectors."""
    dim = sample.shape[1]
    bits = min(BITS, dim)
    x = unit(sample)
    _, vectors = np.linalg.eigh(x.T @ x)
    top = vectors[:, ::-1][:, :bits]
    v = x @ top
    r = np.linalg.qr(np.random.default_rng(5 + start).standard_normal((bits, bits)))[0]
    for _ in range(ROUNDS):
        b = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(b.T @ v)
        r = (u @ w).T
    return top @ r


def substrings(x: np.ndarray, rotations: list[np.ndarray], width: int, tables: int) -> np.ndarray:
    """(vectors, tables): of each unit vector the substrings of its codes."""
    out = []
    for r in rotations:
        on = (x @ r >= 0).astype(np.uint64)
        for at in range(0, max(1, r.shape[1] - width + 1), width):
            bits = on[:, at : at + width]
            out.append((bits << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64))
    return np.stack(out[:tables], axis=1)


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda v: v != 0), F.lit(False))


def bucket_links(rows: np.ndarray, vectors: np.ndarray, codes: np.ndarray, cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each row's class within a bucket, and a spanning forest of them (row numbers). Pairs that met in an earlier table are left out."""
    links, forest = np.zeros(len(rows), np.int64), []
    x = unit(vectors)
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tab = int(rows["tab"][0])
    for at in range(0, len(rows), 256):
        near = x[at : at + 256] @ x.T >= cosine
        if not near.any():
            continue
        i, j = np.nonzero(near)
        i += at
        a, b = rows[i], rows[j]
        # each pair once; of two blocks only pairs across
        keep = (a["cls"] < b["cls"]) & ((a["side"] == 0) | (a["side"] != b["side"]))
        keep &= (a["label"] == b["label"]) & (a["dim"] == b["dim"])
        i, j = i[keep], j[keep]
        fresh = ~(codes[i, :tab] == codes[j, :tab]).any(axis=1)
        i, j = i[fresh], j[fresh]
        np.add.at(links, i, rows["copies"][j])
        np.add.at(links, j, rows["copies"][i])
        for p, q in zip(i.tolist(), j.tolist(), strict=True):
            rp, rq = root(p), root(q)
            if rp != rq:
                parent[rq] = rp
                forest.append((p, q))
    return links, forest


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    ok = usable(F.col("embedding")) & F.col("label").isNotNull()
    own = own.withColumn("cls", F.when(ok, F.xxhash64("label", "embedding")))
    good = own.filter("cls is not null")
    classes = staged(good.groupBy("cls").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("embedding").alias("embedding")), "classes")
    sizes = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).collect()[0][0] or 0
    width = width_for(sizes)
    tables = tables_for(width, cosine)
    # a fixed number of vectors for each length that occurs in the sample
    sample = classes.orderBy(F.hash("cls"), "cls").limit(SAMPLE).select("embedding").collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r[0]), []).append(r[0])
    many = lambda d: -(-tables // max(1, min(BITS, d) // width))
    rotations = {d: [rotation(np.array(v), k) for k in range(many(d))] for d, v in by_dim.items()}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, label, copies = (b.column(c).to_numpy() for c in ("cls", "label", "copies"))
            vectors = b.column("embedding").to_pylist()
            dims = np.array([len(v) for v in vectors])
            for d in np.unique(dims).tolist():
                pick = np.flatnonzero(dims == d)
                x = np.array([vectors[i] for i in pick])
                # a length that is not in the sample
                own = rotations.get(d) or [rotation(np.eye(d), k) for k in range(many(d))]
                codes = substrings(unit(x), own, width, tables)
                raw, wire = [v.tobytes() for v in x], [c.tobytes() for c in codes]
                n = len(pick)
                for t in range(codes.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(label[pick]), pa.array(np.full(n, d), pa.int32()), pa.array(np.full(n, t), pa.int32()), pa.array(codes[:, t].astype(np.int64)), pa.array(cls[pick]), pa.array(wire, pa.binary()), pa.array(copies[pick]), pa.array(raw, pa.binary())],
                        names=["label", "dim", "tab", "value", "cls", "codes", "copies", "vector"],
                    )

    rows = classes.select("cls", "copies", "label", "embedding").mapInArrow(lean(index), INDEXED)
    bucket = ["label", "dim", "tab", "value"]
    counts = rows.groupBy(*bucket).agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK).select(*bucket, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(counts, bucket, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    # a block meets every other block once, and itself
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    dealt = dealt.withColumn("m", F.explode(meets)).withColumn("side", F.when(F.col("m.i") == F.col("m.j"), 0).when(F.col("block") == F.col("m.i"), 1).otherwise(2))
    dealt = dealt.select(F.xxhash64(*bucket, "m.i", "m.j").alias("key"), "label", "dim", "side", "tab", "cls", "codes", "copies", "vector")
    kind = np.dtype([("label", "<i8"), ("dim", "<i4"), ("side", "<i4"), ("tab", "<i4"), ("cls", "<i8"), ("copies", "<i8")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            t = pa.Table.from_batches(held)
            if t.num_rows < 2:
                return None
            rows = np.zeros(t.num_rows, kind)
            for c in kind.names:
                rows[c] = t.column(c).to_numpy()
            outs = []
            for d in np.unique(rows["dim"]).tolist():
                for tab in np.unique(rows["tab"][rows["dim"] == d]).tolist():
                    pick = np.flatnonzero((rows["dim"] == d) & (rows["tab"] == tab))
                    if len(pick) < 2:
                        continue
                    vectors = np.frombuffer(b"".join(t.column("vector").take(pa.array(pick)).to_pylist()), np.float64).reshape(len(pick), d)
                    codes = np.frombuffer(b"".join(t.column("codes").take(pa.array(pick)).to_pylist()), np.uint64).reshape(len(pick), -1)
                    some = rows[pick]
                    links, forest = bucket_links(some, vectors, codes, cosine)
                    hit = np.flatnonzero(links)
                    outs += [(int(some["cls"][i]), None, int(links[i])) for i in hit] + [(int(some["cls"][p]), int(some["cls"][q]), 0) for p, q in forest]
            if not outs:
                return None
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in outs], pa.int64()) for k in range(3)], names=["cls", "other", "links"])

        key, held = None, []
        for b in batches:
            keys = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e == s:
                    continue
                if held and keys[s] != key:
                    if (out := close(held)) is not None:
                        yield out
                    held = []
                key = keys[s]
                held.append(b.slice(s, e - s))
        if held and (out := close(held)) is not None:
            yield out

    found = staged(dealt.repartition("key").sortWithinPartitions("key").mapInArrow(lean(compare), FOUND), "found")
    links = found.filter("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    labels = components(found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    named = classes.select("cls", "copies", "first").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    roots = named.groupBy("component").agg(F.min("first").alias("component_id"))
    result = named.join(roots, "component").join(links, "cls", "left").select("cls", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = own.select("vec_id", "cls").join(result, "cls", "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
