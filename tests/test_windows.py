"""Steps over windows equal the same steps in SQL, whatever the windows; one shuffle of cells; windows counted on both grids."""

import pytest
from pyspark.sql import functions as F

from thermaspark.operators import grid as G
from thermaspark.operators import sharpen as I
from thermaspark.operators import windows as W


def grids(rows, cols, factor):
    return G.Grid(0, factor, 0, factor, -(-cols // factor), -(-rows // factor)), G.Grid(0, 1, 0, 1, cols, rows)


@pytest.fixture(scope="module")
def scene(spark):
    fine = [(k, r, c, None if (r, c) in ((5, 5), (9, 2)) else 290.0 + (r * 7 + c * 3 + k) % 11) for k in (0, 1) for r in range(19) for c in range(16)]
    low = [(k, r, c, None if (r, c) == (0, 4) else 295.0 + (r * 5 + c * 2 + k) % 7, 0 if r in (2, 3) and c in (1, 2, 3) else 1) for k in (0, 1) for r in range(7) for c in range(6) if (r, c) != (1, 0)]
    return spark.createDataFrame(fine, "k int, row int, col int, lst double").repartition(4), spark.createDataFrame(low, "k int, row int, col int, lst double, quality int")


def as_dict(df):
    return {(r["k"], r["row"], r["col"]): r["lst"] for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k, v in a.items():
        assert (v is None) == (b[k] is None) and (v is None or abs(v - b[k]) < 1e-6), k


@pytest.mark.parametrize("size,power", [((35, 35), 4), ((3, 2), 4), ((1, 1), 1), ((7, 6), 1)])
def test_residual_correction(scene, size, power):
    fine, low = scene
    w = W.Windows(*grids(19, 16, 3), 3, *size)
    want = I.correct_smoothed(fine, I.smoothed_residuals(fine, low, 3, ["k"], power), ["k"], power).select("k", "row", "col", "lst")
    same(as_dict(W.correct_residuals(fine, low, ["k"], w, power)), as_dict(want))


@pytest.mark.parametrize("size", [(35, 35), (2, 3)])
def test_terrain_and_filling(spark, size):
    rows = [(0, r, c, float((r * r + 3 * c) % 17) if (r * 7 + c) % 11 else None) for r in range(13) for c in range(11)]
    fine = spark.createDataFrame(rows, "k int, row int, col int, alt double")
    low = spark.createDataFrame([(0, 0, 0, 1.0)], "k int, row int, col int, lst double")

    def run(below, above):
        slope, aspect = W.terrain(above["alt"], 20.0, 20.0)
        return {"slope": slope, "aspect": aspect, "alt": W.filled(above["alt"])}

    got = {(r["row"], r["col"]): r for r in W.over_windows(low, ["lst"], fine, ["alt"], ["k"], W.Windows(*grids(13, 11, 2), 2, *size), 1, run, ["slope", "aspect", "alt"]).collect()}
    shape = {(r["row"], r["col"]): r for r in G.terrain(fine).collect()}
    holes = {(r["row"], r["col"]): r["alt"] for r in G.fill_edge_missing(fine, "alt").collect()}
    assert got.keys() == shape.keys() == holes.keys()
    for k, r in got.items():
        for c, want in (("slope", shape[k]["slope"]), ("aspect", shape[k]["aspect"]), ("alt", holes[k])):
            assert (r[c] is None) == (want is None) and (want is None or abs(r[c] - want) < 1e-9), (k, c)


def test_sharpening_and_correction_in_one_dealing(spark, scene):
    fine, low = scene
    features = fine.select("k", "row", "col", (F.col("row") / 19).alias("b04"), F.when(F.col("lst").isNotNull(), F.col("col") / 16).alias("b08"))
    samples = features.dropna().select("k", "row", "col", "b04", "b08", (285 + 9 * F.col("b04") - 4 * F.col("b08")).alias("lst"), F.lit(1.0).alias("weight"))
    models = I.fit_sharpener(samples, ["b04", "b08"], ["k"], trees=2)
    w = W.Windows(*grids(19, 16, 3), 3, 3, 2)
    hot = I.apply_sharpener(features, models, ["b04", "b08"], ["k"])
    same(as_dict(W.sharpen(features, low, models, ["b04", "b08"], ["k"], w, residual=False)), as_dict(hot))
    want = I.correct_smoothed(hot, I.smoothed_residuals(hot, low, 3, ["k"]), ["k"])
    same(as_dict(W.sharpen(features, low, models, ["b04", "b08"], ["k"], w)), as_dict(want))


def test_cells_are_shuffled_once(scene):
    fine, low = scene
    df = W.correct_residuals(fine, low, ["k"], W.Windows(*grids(19, 16, 3), 3, 3, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_window_counts():
    assert W.Windows(*grids(19, 16, 3), 3, 3, 2).counts() == (3, 3)
    with pytest.raises(ValueError, match="differ in number"):
        W.Windows(G.Grid(0, 3, 0, 3, 6, 7), G.Grid(0, 1, 0, 1, 40, 19), 3, 2, 2)
