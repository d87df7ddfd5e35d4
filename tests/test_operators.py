"""Hand-computed cases: missing values, borders, ties, invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from thermaspark.functions import bands as B
from thermaspark.functions import physics as P
from thermaspark.operators import analysis as H
from thermaspark.operators import composite as D
from thermaspark.operators import grid as G
from thermaspark.operators import mask as C
from thermaspark.operators import matchup as M
from thermaspark.operators import points as J
from thermaspark.operators import temporal as E
from thermaspark.sources import catalog as A
from thermaspark.streaming import rows as S


def constant(spark, n=6, value=7.0):
    return spark.range(n * n).select((F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"), F.lit(value).alias("v"))


def test_encode_decode_round_trip_and_overflow(spark):
    df = spark.createDataFrame([(300.25,), (None,), (9999.0,), (-1.0,), (float("nan"),)], "x double")
    out = df.select(B.encoded(F.col("x"), B.band("S3-LST")).alias("dn")).select("dn", B.decoded(F.col("dn"), B.band("S3-LST")).alias("x")).collect()
    assert [r["dn"] for r in out] == [30025, 0, 0, 0, 0]
    assert out[0]["x"] == pytest.approx(300.25) and all(r["x"] is None for r in out[1:])
    assert B.band("B04").nodata == 0 and B.band("nothing") == B.Band()


def test_flags(spark):
    df = spark.createDataFrame([(16384,), (8,), (None,)], "w int")
    assert [r[0] for r in df.select(C.flag(F.col("w"), "summary_cloud")).collect()] == [1, 0, None]
    assert [r[0] for r in df.select(C.quality_flag(F.col("w"), F.lit(None).cast("double"))).collect()] == [0, 1, 0]
    with pytest.raises(ValueError):
        C.flag(F.col("w"), "nope")


def test_least_cloudy_takes_the_earliest_of_ties(spark):
    t = dt.datetime(2024, 1, 1, 9)
    rows = [(1, t, 0), (2, t + dt.timedelta(hours=1), 0), (3, t + dt.timedelta(days=1), 16384)]
    df = spark.createDataFrame(rows, "acq_id long, acq_time timestamp_ntz, confidence_in int")
    assert [r["acq_id"] for r in C.least_cloudy_per_day(df).collect()] == [1]


def test_daytime_keeps_scenes_without_angles(spark):
    df = spark.createDataFrame([(1, None), (2, 95.0), (2, 10.0), (3, 90.0)], "acq_id long, sza double")
    assert sorted(r[0] for r in C.filter_daytime(df).collect()) == [1, 3]


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubicspline"])
def test_constant_stays_constant(spark, method):
    out = G.regrid(constant(spark), spark, G.Grid(0, 2, 0, 2, 3, 3), G.Grid(0, 1, 0, 1, 6, 6), ["v"], method).collect()
    assert len(out) == 9 and all(r["v"] == pytest.approx(7.0) for r in out)


def test_ramp_is_exact_under_bilinear(spark):
    ramp = constant(spark).withColumn("v", F.col("col") + 0.5)
    out = G.regrid(ramp, spark, G.Grid(1, 1.5, 1, 1.5, 2, 2), G.Grid(0, 1, 0, 1, 6, 6), ["v"], "bilinear").collect()
    assert all(r["v"] == pytest.approx(1 + 1.5 * (r["col"] + 0.5)) for r in out)


def test_spike_gives_the_binomial_kernel(spark):
    spike = constant(spark, 5, 0.0).withColumn("v", F.when((F.col("row") == 2) & (F.col("col") == 2), 16.0).otherwise(0.0))
    out = {(r["row"], r["col"]): r["v"] for r in G.binomial_smooth(spike, "v").collect()}
    assert (out[2, 2], out[1, 2], out[1, 1], out[0, 0]) == (4.0, 2.0, 1.0, 0.0)


def test_edge_fill_and_majority_and_pad(spark):
    holes = constant(spark, 3).withColumn("v", F.when((F.col("row") != 1) | (F.col("col") != 1), F.col("row") * 1.0))
    assert {(r["row"], r["col"]): r["v"] for r in G.fill_edge_missing(holes, "v").collect()}[1, 1] == 1.0
    ties = constant(spark, 2).withColumn("v", F.when(F.col("row") == 0, 5).otherwise(3))
    assert G.block_majority(ties, "v").collect()[0]["v"] == 3
    padded = {(r["row"], r["col"]): r["v"] for r in G.pad_edges(constant(spark, 2), "v", 3, 3).collect()}
    assert len(padded) == 9 and padded[2, 2] == 7.0


def test_terrain_of_a_plane(spark):
    plane = constant(spark, 5).withColumn("alt", F.col("col") * 20.0)
    inner = [r for r in G.terrain(plane).collect() if r["slope"] is not None]
    assert len(inner) == 9 and all(r["slope"] == pytest.approx(1.0) and r["aspect"] == pytest.approx(4.71238898) for r in inner)


def test_bracket_hits_and_outside(spark):
    t = dt.datetime(2024, 1, 1)
    series = spark.createDataFrame([(1, t), (1, t + dt.timedelta(hours=2))], "cell_id int, valid_time timestamp_ntz")
    obs = spark.createDataFrame([(1, t), (1, t + dt.timedelta(minutes=30)), (1, t + dt.timedelta(hours=3)), (2, t)], "cell_id int, acq_time timestamp_ntz")
    out = sorted((r["acq_time"], r["frac"]) for r in E.bracket(obs, series, "acq_time", "valid_time", ["cell_id"]).collect())
    assert out == [(t, 1.0), (t + dt.timedelta(minutes=30), 0.75)]


def test_simultaneous_is_strict_unless_inclusive(spark):
    t = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(t,)], "lt timestamp_ntz")
    b = spark.createDataFrame([(t + dt.timedelta(minutes=10),), (t - dt.timedelta(minutes=9),)], "rt timestamp_ntz")
    assert E.simultaneous(a, b, 10, left_time="lt", right_time="rt").count() == 1
    assert E.simultaneous(a, b, 10, True, "lt", "rt").count() == 2


def test_interpolation_fills_inside_only(spark):
    d = lambda m, x: dt.date(2024, m, x)
    df = spark.createDataFrame([(0, 0, d(1, 1), None), (0, 0, d(1, 11), 1.0), (0, 0, d(2, 1), 4.0)], "row_hr int, col_hr int, dekad date, v double")
    out = {r["dekad"]: r["v"] for r in D.interpolate_linear(df, ["v"]).collect()}
    assert out == {d(1, 1): None, d(1, 11): 1.0, d(1, 21): pytest.approx(1 + 3 * 10 / 21), d(2, 1): 4.0}


def test_granules_and_stamps(spark):
    names = [(f"ECO1B_{k}_12345_001_20240101T101010_x.h5",) for k in ("LSTE", "GEO", "CLOUD")]
    out = E.match_granules(spark.createDataFrame(names, "name string")).collect()
    assert len(out) == 1 and out[0]["acq_time"] == dt.datetime(2024, 1, 1, 10, 10, 10)
    one = spark.createDataFrame([("a_20240101T000000.tif",), ("a_20240101T000000_20240102T000000.tif",)], "path string")
    first, second = A.parse_stamps(F.col("path"))
    assert [tuple(r) for r in one.select(first, second).collect()] == [(None, None), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))]


def test_unknown_tile_is_an_error(spark):
    tiles = spark.createDataFrame([("31PDR", 0.0, 1.0, 2.0, 3.0)], "tile string, minx double, miny double, maxx double, maxy double")
    assert A.resolve_extent(tiles, "31PDR").collect()[0]["maxy"] == 3.0
    with pytest.raises(Exception, match="unknown tile"):
        A.resolve_extent(tiles, "99XXX").collect()


def test_azimuths_turn_or_fail(spark):
    df = spark.createDataFrame([(1, 190.0, 10.0, 300.0), (2, 10.0, 12.0, 50.0)], "pair_id int, s3_saa double, validation_saa double, validation_vaa double")
    assert sorted(r["validation_vaa"] for r in M.align_azimuth(df).collect()) == [50.0, 120.0]
    with pytest.raises(Exception, match="do not match"):
        M.align_azimuth(df.withColumn("s3_saa", F.lit(90.0))).collect()


def test_outside_centroid_is_dropped(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    horseshoe = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (8.0, 9.0), (8.0, 1.0), (1.0, 1.0), (1.0, 9.0), (0.0, 9.0)]
    df = spark.createDataFrame([(1, square), (2, horseshoe)], "poly_id int, vertices array<struct<x:double,y:double>>")
    assert [tuple(r) for r in J.polygon_centroids(df).collect()] == [(1, 1.0, 1.0)]


def test_legacy_matchup_columns(spark, tmp_path):
    (tmp_path / "new").mkdir()
    (tmp_path / "old").mkdir()
    (tmp_path / "new/a.csv").write_text("lst_S3hr,validation_vza\n300.5,4\n")
    (tmp_path / "old/b.csv").write_text("lst_S3hr,validation_view_zenith\n301.5,5\n")
    rows = A.read_matchups(spark, [str(tmp_path / "new")], [str(tmp_path / "old")]).orderBy("lst_s3hr").collect()
    assert [(r["lst_s3hr"], r["validation_vza"]) for r in rows] == [(300.5, 4.0), (301.5, 5.0)]


def test_sample_is_seeded(spark):
    df = spark.range(3000).select(F.lit("f").alias("s3_time"), "id")
    one, two, three = (sorted(r["id"] for r in H.balanced_sample(df, ["id"], s, 1000).collect()) for s in (1, 1, 2))
    assert one == two != three and len(one) == int(1000 * (1 + 0.4771212547196624))


def test_zero_temperature_is_left_alone(spark):
    df = spark.createDataFrame([(0.0, 10.0), (300.0, 0.0)], "t double, v double")
    assert [r[0] for r in df.select(P.correct_lst(F.col("t"), F.col("v"), 1.0, 10.0, 5.0)).collect()] == [0.0, 290.0]


def test_row_steps_run_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(300.0, 16384, 0.1, 0.0), (300.0, 8, 0.1, 0.0)], "lst double, confidence_in int, lst_uncertainty double, vza double")
    df.write.parquet(str(tmp_path / "in"))
    stream = S.corrected_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), 1.0, 10.0, None)
    q = stream.writeStream.format("memory").queryName("corrected").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r["lst"] or 0.0, r["quality"]) for r in spark.table("corrected").collect()) == [(0.0, 0), (290.0, 1)]
