"""Tall swaths: nothing that grows in the plan or on the driver, no task with all pairs."""

import re

import pytest
from pyspark.sql import functions as F

from thermaspark.operators import grid as G
from thermaspark.operators import swath as S


@pytest.fixture
def pixels(spark):
    return spark.range(400).select(F.col("id").alias("px_id"), (25.0 + F.col("id") % 2 * 0.0007).alias("lon"), (-15.0 - F.floor(F.col("id") / 2) * 0.07).alias("lat"), F.col("id").cast("double").alias("v"))


def test_a_tall_grid_is_no_literal_and_no_broadcast(spark, pixels, monkeypatch):
    plans, own = [], S.staged

    def spy(df, name):
        plans.append(df._jdf.queryExecution().toString())
        return own(df, name)

    monkeypatch.setattr(S, "staged", spy)
    out = S.grid_swath_plane(pixels, G.Grid(25.0, 0.0007, -15.0, -0.0007, 2, 20_000), ["v"])
    plans.append(out._jdf.queryExecution().toString())
    assert max(map(len, plans)) < 200_000
    assert "BroadcastHashJoin" not in "".join(plans)
    assert out.count() > 400


def test_pairs_of_pixels_and_cells_are_dealt_before_they_are_made(spark, pixels):
    g = G.Grid(25.0, 0.0007, -15.0, -0.0007, 2, 20_000)
    out = G.grid_swath(pixels, g, ["v"], at_once=1000)
    tasks = re.findall(r"hashpartitioning\([^)]*\)[^\n]*?, (\d+)\), REPARTITION_BY_NUM", out._jdf.queryExecution().executedPlan().toString())
    assert tasks and int(tasks[0]) == -(-400 * 49 // 1000)
    key = lambda r: (r["row"], r["col"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, G.grid_swath(pixels, g, ["v"]).collect())) and len({key(r) for r in out.collect()}) == out.count()
