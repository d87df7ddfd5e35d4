"""Tables written in the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset (tests, one machine) a folder of this session."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again; a lost executor costs only its running tasks."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/thermal/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def drop_staged(df: DataFrame) -> None:
    """Deletes a table that staged() made and that nothing reads any more."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
