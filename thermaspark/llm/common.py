"""What the operators of this subpackage share: the shared folder, staged tables, Arrow batches, files and components."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bounds of an Arrow batch sent to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 3 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset (tests, one machine) a folder of this session."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again. Cuts the lineage; a lost executor costs only its running tasks."""
    spark = df.sparkSession
    at = fresh(spark, name)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def bounded(df: DataFrame, most: int) -> DataFrame:
    """df, staged, to be broadcast if it has at most so many rows; a larger one is joined by a shuffle, with the same result."""
    kept = staged(df, "side")
    return F.broadcast(kept) if kept.count() <= most else kept


def drop_staged(df: DataFrame) -> None:
    """Deletes a table that staged() made and that nothing reads any more."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches in rows and bytes, since texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n+1 offsets of a string array; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


# -- workers ---------------------------------------------------------------

#: The one object that this worker process keeps from task to task, under its key.
_kept: dict[tuple, Any] = {}


def kept(make: Callable[..., Any], *args: Any) -> Any:
    """make(*args), made once in a worker process for tasks of one operator; another's object is let go first."""
    key = (make.__name__, *args)
    if key not in _kept:
        give_back()
        _kept[key] = make(*args)
    return _kept[key]


def give_back() -> None:
    """Lets go of what kept() holds and returns freed memory to the system: Spark reuses a worker for other operators' tasks."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if os.name == "posix" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, of a task that starts with nothing kept by others and leaves nothing behind."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


# -- files ---------------------------------------------------------------


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI of the shared folder; a path without a scheme is local."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), os.path.abspath(uri))


# -- components ------------------------------------------------------------


def _empty(df: DataFrame) -> bool:
    return not df.take(1)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges(a, b); component is its smallest node.

    Each round hooks a node to its smallest neighbour, follows these links a few steps and contracts the
    graph, so that the edges shrink geometrically. Groups are only ever reduced by min(), which combines
    before the shuffle; joins are between narrow rows and may be split by AQE.
    """
    spark = edges.sparkSession
    flat = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = staged(flat.filter("a < b").distinct(), "edges")
    labels = None
    while not _empty(left):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("up"))
        up = staged(up, "up")
        for _ in range(2):
            over = up.select(F.col("a").alias("up"), F.col("up").alias("over"))
            jumped = staged(up.join(over, "up").select("a", F.col("over").alias("up")), "up")
            drop_staged(up)
            up = jumped
        if labels is None:
            new = up.select(F.col("a").alias("node"), F.col("up").alias("component"))
        else:
            hop = up.select(F.col("a").alias("component"), "up")
            new = labels.join(hop, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        new = staged(new, "labels")
        ua, ub = up.select("a", F.col("up").alias("ua")), up.select(F.col("a").alias("b"), F.col("up").alias("ub"))
        rest = left.join(ua, "a").join(ub, "b").filter("ua != ub")
        rest = staged(rest.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
        for x in (left, up, *([] if labels is None else [labels])):
            drop_staged(x)
        left, labels = rest, new
    if labels is None:
        kind = edges.schema["a"].dataType
        return spark.createDataFrame([], "node long, component long").select(F.col("node").cast(kind), F.col("component").cast(kind))
    return labels

