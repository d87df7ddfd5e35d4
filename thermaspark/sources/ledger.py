"""A ledger of finished units of work: what it names is complete, what it does not name was never made.

A commit is one small file that is moved into place after the data it names are written, so that a job that is cut leaves
at most files that nothing refers to. Stages read each other through the ledger and go on where it ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENT = ("minx", "miny", "maxx", "maxy")
SCHEMA = "stage string, unit string, minx double, miny double, maxx double, maxy double, path string"


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def entries(spark: SparkSession, root: str, stage: str | None = None) -> DataFrame:
    at = f"{root}/ledger"
    out = spark.read.schema(SCHEMA).parquet(at) if _there(spark, at) else spark.createDataFrame([], SCHEMA)
    return out.filter(F.col("stage") == stage) if stage is not None else out


def commit(units: DataFrame, root: str, stage: str, path: str) -> None:
    """units: unit and the extent they were made for. One file, so all of them or none."""
    rows = units.select(F.lit(stage).alias("stage"), "unit", *EXTENT, F.lit(path).alias("path"))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/ledger")


def pending(units: DataFrame, root: str, stage: str) -> DataFrame:
    """Units that are not finished; one that was finished for another extent is an error."""
    known = entries(units.sparkSession, root, stage).select("unit", *(F.col(c).alias(f"__{c}") for c in EXTENT), F.lit(True).alias("__done")).distinct()
    same = F.lit(True)
    for c in EXTENT:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    refused = F.raise_error(F.concat(F.lit(f"{stage}: "), "unit", F.lit(" was made for another extent"))).cast("boolean")
    return units.join(known, "unit", "left").filter(F.when(F.col("__done").isNull(), True).when(same, False).otherwise(refused)).select("unit", *EXTENT)


def run_stage(units: DataFrame, root: str, stage: str, make: Callable[[DataFrame], DataFrame], by: Sequence[str] = (), at_once: int = 256, passes: int = 4) -> int:
    """Makes what is pending, `at_once` units or more to a commit; the number of units made. make(units): the rows of these.

    Every commit reads the inputs anew, so that there are no more than `passes` of them, however many units there are.
    """
    left = pending(units, root, stage)
    n = left.count()
    parts = min(-(-n // at_once), passes)
    for i in range(parts):
        own = left.filter(F.pmod(F.xxhash64("unit"), F.lit(parts)) == i)
        path = f"{root}/{stage}/{uuid.uuid4().hex}"
        writer = make(own).write
        (writer.partitionBy(*by) if by else writer).parquet(path)
        commit(own, root, stage, path)
    return n


def finished(spark: SparkSession, root: str, stage: str) -> DataFrame:
    """The rows of a stage's finished units, from the paths that its commits name."""
    paths = [r["path"] for r in entries(spark, root, stage).select("path").distinct().collect()]
    if not paths:
        raise ValueError(f"nothing of {stage} is finished")
    return spark.read.parquet(*paths)
