"""Products and chains by hand, and that registered queries have rows."""

import glob
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from thermaspark.operators import analysis, grid, mask, temporal
from thermaspark.fixtures import fixture
from thermaspark.plans import catalogue, products
from thermaspark.plans import pipelines as K
from thermaspark.plans import products as X

from .conftest import DATA

@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).take(1)


def test_known_coordinates(spark):
    """On the central meridian the northing is the scale times the meridian's arc; zones end 333,978.557 m from it at the equator."""
    some = spark.createDataFrame([(27.0, 0.0), (27.0, 45.0), (30.0, 0.0), (24.0, 0.0)], "lon double, lat double")
    x, y = grid.reproject(F.col("lon"), F.col("lat"), 4326, 32635)
    got = [(round(r[0], 3), round(r[1], 3)) for r in some.select(x, y).collect()]
    assert got == [(500000.0, 0.0), (500000.0, 4982950.4), (833978.557, 0.0), (166021.443, 0.0)]


def test_granules_without_a_key_match_nothing(spark):
    names = [("ECO_LSTE_x.h5",), ("LSTE_y",), ("GEO_1",), ("GEO_2",), ("CLOUD",), ("ECO_LSTE_00001_001_20240101T101010.h5",), ("ECO_GEO_00001_001_20240101T101010.h5",), ("ECO_CLOUD_00001_001_20240101T101010.h5",)]
    assert temporal.match_granules(spark.createDataFrame(names, "name string")).count() == 1


def test_pending_refuses_another_extent(spark):
    a = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, None)], "k int, minx double")
    done = spark.createDataFrame([(2, 0.0), (3, None)], "k int, minx double")
    assert [r["k"] for r in products.pending(a, done, ["k"], ["minx"]).collect()] == [1]
    with pytest.raises(PySparkException, match="another extent"):
        products.pending(a, done.withColumn("minx", F.lit(5.0)), ["k"], ["minx"]).collect()


def test_samples_and_parameters(spark, tmp_path):
    """Without a cut every sample has all rows, and the parameters are those of all; both are written by sample."""
    m = catalogue.fixture(spark, DATA, "matchup")
    got = products.correction_parameters(m, m.columns, (1, 2)).orderBy("sample_id").collect()
    whole = analysis.estimate_parameters(analysis.load_analysis_frame(m).withColumn("sample_id", F.lit(0))).first()
    assert all(abs(r[c] - whole[c]) < 1e-9 for r in got for c in ("gain", "offset", "r2", "dir_par"))
    some = products.samples(m, m.columns, (1, 2), 50)
    products.write_samples(some, f"{tmp_path}/samples")
    products.write_params(some.groupBy("sample_id").count(), f"{tmp_path}/params")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/samples").count() == some.count() and spark.read.json(f"{tmp_path}/params").count() == 2
    assert len(glob.glob(f"{tmp_path}/samples/sample_id=*")) == 2


def test_the_product_has_values(spark):
    rows = catalogue.QUERIES["k6_lst_ta_product"](spark, DATA).agg(F.count("*"), F.count_if(F.col("lst_ta") != -999), F.countDistinct("acq_id"), F.max(F.abs(F.when(F.col("lst_ta") != -999, F.col("lst_ta"))))).first()
    assert rows[0] > 0 and rows[1] > 0.2 * rows[0] and rows[2] > 1 and rows[3] < 6000


def test_the_product_comes_with_its_manifest_and_unusable_scenes(spark):
    s3, fine = fixture(spark, DATA, "s3_obs"), catalogue.dated_features(spark, DATA)
    cell = (F.floor(F.col("row") / 10) * 2 + F.floor(F.col("col") / 10)).cast("int")
    last = s3.agg(F.max("acq_id")).first()[0]
    # an acquisition all of whose pixels are too uncertain
    spoilt = s3.withColumn("lst_uncertainty", F.when(F.col("acq_id") == last, 9.0).otherwise(F.col("lst_uncertainty")))
    product, files, unusable = X.lst_ta_product(spoilt, fine, ["b04", "b08"], 2, fixture(spark, DATA, "era5_hourly"), cell, tile="31PDR", trees=2)
    made = {r["acq_id"]: r["acq_time"] for r in product.select("acq_id", "acq_time").distinct().collect()}
    left = {r["acq_id"] for r in unusable.collect()}
    chosen = {r["acq_id"] for r in K.prepare_s3(spoilt).select("acq_id").distinct().collect()}
    assert made and not left & made.keys() and left | made.keys() == chosen and (last in left) == (last in chosen)
    assert {r["filename"] for r in files.collect()} == {f"LST-Ta_{t:%Y%m%dT%H%M%S}_31PDR.tif" for t in made.values()}


def test_reading_is_pushed_down(spark):
    plan = catalogue.QUERIES["a1_read_cells"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag)" in plan and "EqualTo(l_returnflag,R)" in plan and "l_extendedprice" not in plan


def test_regrid_mode_takes_centres_and_of_equal_counts_the_smallest(spark):
    rows = [(0, c, k) for c, k in enumerate([7, 7, 3, 3, 5, None, 9])]
    got = grid.regrid_mode(spark.createDataFrame(rows, "row int, col int, k int"), "k", grid.Grid(0, 10.0, 0, -10.0, 7, 1), grid.Grid(0, 25.0, 0, -10.0, 2, 1))
    # centres 5, 15 | 25, 35, 45 | 55 is missing and 65 lies outside
    assert sorted(map(tuple, got.collect())) == [(0, 0, 7), (0, 1, 3)]
    tie = spark.createDataFrame([(0, 0, 8), (0, 1, 2)], "row int, col int, k int")
    assert grid.regrid_mode(tie, "k", grid.Grid(0, 10.0, 0, -10.0, 2, 1), grid.Grid(0, 20.0, 0, -10.0, 1, 1)).first()["k"] == 2


def test_scl_mask_equals_runs_along_rows_then_columns(spark):
    """Clouds in blocks on a grid with holes, two dates: eroded, then dilated, each along rows and then columns."""
    rng = random.Random(5)
    scene = {(d, r, c): 9 if (r // 4 + c // 5 + d) % 7 == 0 else 1 if (r // 3 * c // 6) % 5 == 1 else 4 for d in (0, 1) for r in range(24) for c in range(30) if rng.random() < 0.95}

    def spread(values, axis, reach, pick):
        near = lambda k: [tuple(x + o if i == axis else x for i, x in enumerate(k)) for o in range(-reach, reach + 1)]
        return {k: pick(values[n] for n in near(k) if n in values) for k in values}

    want = {k: 0 for k in scene}
    for hidden, kernel in ((lambda s: s not in (2, 4, 5, 6, 7), 3), (lambda s: s in (3, 8, 9, 10, 11), 7)):
        m = {k: int(hidden(s)) for k, s in scene.items()}
        for reach, pick in ((1, min), (kernel // 2, max)):
            for axis in (1, 2):
                m = spread(m, axis, reach, pick)
        want = {k: max(v, m[k]) for k, v in want.items()}
    cells = spark.createDataFrame([(*k, s) for k, s in scene.items()], "acq_date int, row_hr int, col_hr int, scl int")
    got = {tuple(r)[:3]: r["masked"] for r in mask.scl_mask(cells, kernel1=3, kernel2=7).collect()}
    assert got == want and 0.1 < sum(want.values()) / len(want) < 0.9


def test_aeqd_keeps_known_arcs(spark):
    """A degree of the equator is 111,319.491 m, the first degree of a meridian 110,574.389 m; the centre is 0, 0."""
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0)], "lon double, lat double")
    rows = [(r["x"], r["y"]) for r in grid.to_aeqd(df, "lon", "lat", 0.0, 0.0).collect()]
    expected = [(111319.491, 0), (0, 110574.389), (-111319.491, 0), (0, 0)]
    assert all(abs(a - b) < 2e-3 for got, want in zip(rows, expected, strict=False) for a, b in zip(got, want, strict=True))
    assert rows[4] == (None, None)


def test_padding_is_by_key(spark):
    df = spark.createDataFrame([("a", 0, 0, 1.0), ("b", 0, 0, 2.0), ("b", 1, 0, 3.0)], "k string, row int, col int, v double")
    got = {(r["k"], r["row"], r["col"]): r["v"] for r in grid.pad_edges(df, "v", 2, 2, ["k"]).collect()}
    assert got == {("a", r, c): 1.0 for r in (0, 1) for c in (0, 1)} | {("b", r, c): 2.0 + r for r in (0, 1) for c in (0, 1)}
