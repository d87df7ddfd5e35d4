"""Swaths on grids against brute force in the same plane, and the chain from swath to parameters on planted ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from thermaspark.operators import analysis, matchup
from thermaspark.operators import grid as G
from thermaspark.operators import swath as S
from thermaspark.plans import product_queries, products

from .conftest import DATA


@pytest.mark.parametrize("radius,first", [(210.0, None), (210.0, 20.0), (60.0, 500.0)])
def test_nearest_equals_brute_force(spark, radius, first):
    r = random.Random(3)
    g = G.Grid(25.0, 0.0007, -15.0, -0.0007, 14, 12)
    pixels = [(k, i, 25.0 + r.random() * 0.0098, -15.0 - r.random() * 0.0084 * (0.4 if k else 1), float(i)) for k in (0, 1) for i in range(60)]
    pixels += [(0, 900, 25.003, -15.003, 1.0), (0, 901, 25.003, -15.003, 2.0), (0, 902, None, -15.0, 3.0)]
    df = spark.createDataFrame(pixels, "k int, px_id int, lon double, lat double, v double")
    got = {(x["k"], x["row"], x["col"]): (x["distance"], x["v"]) for x in S.grid_swath_plane(df, g, ["v"], ["k"], radius, first).collect()}
    plane = [p for p in G.to_aeqd(df, "lon", "lat", g.x0 + g.dx * 7, g.y0 + g.dy * 6).collect() if p["x"] is not None]
    cells = spark.range(12 * 14).select((F.col("id") / 14).cast("int").alias("row"), (F.col("id") % 14).cast("int").alias("col"))
    lon, lat = g.centre(F.col("row"), F.col("col"))
    want = {}
    for c in G.to_aeqd(cells.withColumns({"lon": lon, "lat": lat}), "lon", "lat", g.x0 + g.dx * 7, g.y0 + g.dy * 6).collect():
        for k in (0, 1):
            best = min((round(math.hypot(p["x"] - c["x"], p["y"] - c["y"]), 6), p["px_id"], p["v"]) for p in plane if p["k"] == k)
            if best[0] <= radius:
                want[k, c["row"], c["col"]] = (best[0], best[2])
    assert got.keys() == want.keys() and len(got) > 100
    assert all(abs(got[k][0] - want[k][0]) < 2e-6 and got[k][1] == want[k][1] for k in got)


def test_parameters_from_swath_are_the_planted_ones(spark):
    rows = product_queries.k8_parameters_from_swath(spark, DATA).collect()
    assert [r["sample_id"] for r in sorted(rows)] == [1, 2, 3] or len(rows) == 3
    for r in rows:
        assert abs(r["gain"] - 1.1) < 1e-4 and abs(r["offset"] + 30) < 0.05 and r["r2"] > 0.9999 and abs(r["dir_par"]) < 0.05


def test_matchups_leave_out_what_is_done_and_what_is_not_simultaneous(spark):
    granules, scenes, cover, g = product_queries.swath_inputs(spark, DATA)
    late = scenes.withColumn("time", F.when(F.col("scene") == "s2", F.timestamp_add("MINUTE", F.lit(20), F.col("time"))).otherwise(F.col("time")))
    done = spark.createDataFrame([("31PDR", "g1|s1")], "tile string, pair_id string")
    got = products.matchups_from_swath(granules, late, cover, g, 2, done=done)
    assert {r["pair_id"] for r in got.select("pair_id").distinct().collect()} == {"g3|s3"}
    assert got.filter("s3_time != '20240304T093400' OR land_cover IS NULL").count() == 0


def test_nearest_stops_when_no_cell_is_open_and_projects_a_grid_once(spark, monkeypatch):
    written, own = [], S.staged

    def spy(df, name):
        out = own(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(S, "staged", spy)
    g = G.Grid(25.0, 0.0007, -15.0, -0.0007, 5, 4)
    pixels = spark.range(40).select((F.col("id") % 2).cast("int").alias("k"), F.col("id").alias("px_id"), F.lit(1.0).alias("v"), (25.0 + ((F.col("id") / 2).cast("int") % 5 + 0.5) * 0.0007).alias("lon"), (-15.0 - ((F.col("id") / 10).cast("int") + 0.5) * 0.0007).alias("lat"))
    assert S.grid_swath_plane(pixels, g, ["v"], ["k"]).count() == 40
    assert written == [("places", 20), ("pixels", 40), ("nearest", 40), ("open", 0)]


def test_matchups_take_each_side_once(spark):
    """Joins for columns of the same side would do again whatever made it."""
    calls = spark.sparkContext.accumulator(0)

    def seen(i):
        calls.add(1)
        return i

    count = F.udf(seen, "int").asNondeterministic()
    angles = {f: F.lit(10.0) for f in ("vza", "vaa", "sza", "saa")}
    side = spark.range(30).select(F.lit(1).alias("pair_id"), count(F.col("id").cast("int")).alias("row"), F.lit(0).alias("col"), F.when(F.col("id") == 3, 0.0).otherwise(290.0).alias("lst"), F.lit("t").alias("acq_time")).withColumns(angles)
    plain = spark.range(30).select(F.lit(1).alias("pair_id"), F.col("id").cast("int").alias("row"), F.lit(0).alias("col"), F.lit(280.0).alias("lst"), F.lit("t").alias("acq_time"), F.lit(0).alias("cloudmask"), F.lit(1.0).alias("land_fraction")).withColumns(angles)
    cover = spark.createDataFrame([(0, 0, 10)], "row int, col int, land_cover int")
    assert len(matchup.build_matchups(side, plain, cover).collect()) == 29
    assert calls.value <= 30


def test_samples_of_all_seeds_are_those_of_each(spark):
    df = spark.range(4000).select((F.col("id") % 3).cast("string").alias("s3_time"), F.col("id"))
    got = sorted((r["sample_id"], r["id"]) for r in products.samples(df, ["id"], (1, 2), 300).collect())
    assert got == sorted((s, r["id"]) for s in (1, 2) for r in analysis.balanced_sample(df, ["id"], s, 300).collect()) and len(got) > 1800
