"""Preprocessing that is cut and run again makes only what is missing, and refuses another extent."""

import dataclasses

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from thermaspark.operators.grid import Grid
from thermaspark.plans import preprocess as PP
from thermaspark.sources import ledger

AREA = Grid(25.0, 0.01, -15.0, -0.01, 4, 4)
TILE = PP.Tile((25.0, -15.04, 25.04, -15.0), AREA, 4326, AREA, Grid(25.0, 0.02, -15.0, -0.02, 2, 2), AREA, 4326)


@pytest.fixture(scope="module")
def inputs(spark):
    time = F.to_timestamp_ntz(F.lit("2024-01-05 09:30:00"))
    s3 = spark.range(5 * 16).select((F.col("id") / 16).cast("int").alias("acq_id"), time.alias("acq_time"), (F.col("id") % 16 / 4).cast("int").alias("row"), (F.col("id") % 4).cast("int").alias("col"))
    s3 = s3.withColumns({"lst": F.col("row") + 290.0, "lst_uncertainty": F.lit(0.5), "confidence_in": F.lit(0), "vza": F.col("col") * 3.0})
    s2 = spark.range(3 * 16).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 16).cast("int")).alias("acq_date"), (F.col("id") % 16 / 4).cast("int").alias("row"), (F.col("id") % 4).cast("int").alias("col"), F.lit(0.1).alias("b04"), F.lit(7).alias("scl"))
    return s3, s2, s2.select("row", "col", (F.col("row") * 10.0).alias("alt")).distinct()


def test_resume_makes_only_what_is_missing(spark, inputs, tmp_path, monkeypatch):
    root, (s3, s2, dem) = str(tmp_path), inputs
    assert PP.preprocess(root, s3.filter("acq_id < 2"), s2, dem, TILE) == {"terrain": 1, "optical": 3, "thermal": 2, "angles": 2}
    own, calls = ledger.commit, []

    def cut(units, at, stage, path):
        calls.append(stage)
        if calls.count("thermal") == 2:
            raise KeyboardInterrupt  # data are written, the commit is not
        own(units, at, stage, path)

    monkeypatch.setattr(ledger, "commit", cut)
    with pytest.raises(KeyboardInterrupt):
        PP.preprocess(root, s3, s2, dem, TILE, at_once=1)
    monkeypatch.setattr(ledger, "commit", own)
    before = ledger.entries(spark, root, "thermal").count()
    assert 2 <= before < 5
    assert PP.preprocess(root, s3, s2, dem, TILE) == {"terrain": 0, "optical": 0, "thermal": 5 - before, "angles": 3}
    assert PP.preprocess(root, s3, s2, dem, TILE) == dict.fromkeys(PP.STAGES, 0)
    thermal, angles = PP.read(spark, root, "thermal"), PP.read(spark, root, "angles")
    assert thermal.count() == thermal.select("acq_id", "row", "col").distinct().count() == 5 * 4
    assert angles.count() == angles.select("acq_id", "row", "col").distinct().count() == 5 * 16
    assert "scl" not in PP.read(spark, root, "optical").columns and PP.read(spark, root, "optical").count() == 48
    whole = tmp_path / "whole"
    PP.preprocess(str(whole), s3, s2, dem, TILE)
    for stage in PP.STAGES:
        a, b = PP.read(spark, root, stage, False), PP.read(spark, str(whole), stage, False)
        assert a.exceptAll(b.select(a.columns)).count() == b.select(a.columns).exceptAll(a).count() == 0


def test_another_extent_is_refused(spark, inputs, tmp_path):
    root, (s3, s2, dem) = str(tmp_path), inputs
    PP.preprocess(root, s3.filter("acq_id = 0"), s2, dem, TILE)
    with pytest.raises(PySparkException, match="another extent"):
        PP.preprocess(root, s3, s2, dem, dataclasses.replace(TILE, extent=(24.0, -15.04, 25.04, -15.0)))
    with pytest.raises(ValueError, match="nothing of angles"):
        PP.read(spark, f"{root}/elsewhere", "angles")
