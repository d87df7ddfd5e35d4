"""Stages of many units: few passes over the inputs."""

from pyspark.sql import functions as F

from thermaspark.sources import ledger


def test_passes_do_not_grow_with_the_units(spark, tmp_path):
    root, calls = str(tmp_path), []
    units = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("unit"), *(F.lit(0.0).alias(c) for c in ledger.EXTENT))

    def make(own):
        calls.append(own)
        return own.select("unit")

    assert ledger.run_stage(units, root, "s", make, at_once=100) == 3000
    assert 1 < len(calls) <= 4
    assert ledger.finished(spark, root, "s").distinct().count() == 3000
    assert ledger.run_stage(units, root, "s", make) == 0
