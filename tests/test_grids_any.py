"""Means between any two grids, the projection back, and composites in one shuffle, by hand and against earlier ways."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from thermaspark.operators import composite as D
from thermaspark.operators import grid as G


def plain_area(values, source, target):
    out = {}
    for i in range(target.n_rows):
        for j in range(target.n_cols):
            y = sorted((target.y0 + i * target.dy, target.y0 + (i + 1) * target.dy))
            x = sorted((target.x0 + j * target.dx, target.x0 + (j + 1) * target.dx))
            total = weight = 0.0
            for (r, c), v in values.items():
                a = sorted((source.y0 + r * source.dy, source.y0 + (r + 1) * source.dy))
                b = sorted((source.x0 + c * source.dx, source.x0 + (c + 1) * source.dx))
                w = max(0.0, min(y[1], a[1]) - max(y[0], a[0])) * max(0.0, min(x[1], b[1]) - max(x[0], b[0]))
                if v is not None and w > 1e-9:
                    total, weight = total + w * v, weight + w
            if weight:
                out[i, j] = total / weight
    return out


@pytest.mark.parametrize("target", [G.Grid(0, 2.5, 0, -2.5, 3, 3), G.Grid(-1.3, 0.7, 0.4, -0.7, 13, 14), G.Grid(0.25, 3.0, -8, 1.5, 2, 6)])
def test_area_means(spark, target):
    r = random.Random(1)
    source = G.Grid(0, 1.0, 0, -1.0, 7, 8)
    values = {(i, j): None if (i, j) in ((2, 2), (0, 6)) else r.random() for i in range(8) for j in range(7)}
    cells = spark.createDataFrame([(i, j, v) for (i, j), v in values.items()], "row int, col int, v double")
    got = {(x["row"], x["col"]): x["v"] for x in G.regrid_area(cells, source, target, ["v"]).collect() if x["v"] is not None}
    want = plain_area(values, source, target)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_area_means_keep_constants_and_aligned_means(spark):
    cells = spark.createDataFrame([(i, j, float(i * 6 + j)) for i in range(6) for j in range(6)], "row int, col int, v double")
    a = {(x["row"], x["col"]): x["v"] for x in G.regrid_area(cells, G.Grid(0, 1, 0, 1, 6, 6), G.Grid(0, 3, 0, 3, 2, 2), ["v"]).collect()}
    b = {(x["row"], x["col"]): x["v"] for x in G.regrid_average(cells, 3, ["v"]).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_aeqd_there_and_back(spark):
    r = random.Random(2)
    for lon0, lat0 in ((25.0, -15.0), (0.0, 0.0), (179.5, 60.0), (10.0, -89.0)):
        points = [(lon0 + r.uniform(-4, 4), max(-89.5, min(89.5, lat0 + r.uniform(-4, 4)))) for _ in range(200)] + [(lon0, lat0), (None, 1.0)]
        df = G.to_aeqd(spark.createDataFrame(points, "a double, b double"), "a", "b", lon0, lat0)
        for x in G.from_aeqd(df, "x", "y", lon0, lat0).collect():
            if x["a"] is None:
                assert x["lon"] is None and x["lat"] is None
            else:
                east = (x["lon"] - x["a"]) * 111_320 * math.cos(math.radians(x["b"]))
                assert math.hypot(east, (x["lat"] - x["b"]) * 111_320) < 1e-3


def test_known_arcs_back(spark):
    # a quarter of a degree of the meridian from the equator, and of the equator
    df = spark.createDataFrame([(0.0, 110_574.2758 / 4 * 1.0), (6378137.0 * math.pi / 180, 0.0)], "x double, y double")
    a, b = G.from_aeqd(df, "x", "y", 30.0, 0.0).collect()
    assert abs(a["lon"] - 30) < 1e-9 and abs(a["lat"] - 0.25) < 1e-6
    assert abs(b["lon"] - 31) < 1e-9 and abs(b["lat"]) < 1e-9


def test_index_maps_up_and_down(spark):
    g = G.Grid(10.0, 2.0, 50.0, -2.0, 5, 5)
    df = spark.createDataFrame([(10.0, 50.0), (11.0, 49.5), (12.0, 48.0)], "x double, y double")
    up, down = g.rowcol_up(F.col("x"), F.col("y")), g.rowcol(F.col("x"), F.col("y"))
    assert [tuple(r) for r in df.select(*up, *down).collect()] == [(0, 0, 0, 0), (1, 1, 0, 0), (1, 1, 1, 1)]


def test_filled_composite_equals_composite_then_filling(spark):
    r = random.Random(4)
    day0 = datetime.date(2023, 12, 3)
    rows = [(p, 0, day0 + datetime.timedelta(r.randint(0, 120)), None if r.random() < 0.2 else r.random(), r.random()) for p in range(12) for _ in range(r.randint(1, 9))]
    df = spark.createDataFrame([*rows, (99, 0, day0, None, None)], "row_hr int, col_hr int, acq_date date, a double, b double").repartition(4)
    want = {tuple(x[:3]): x for x in D.interpolate_linear(D.dekad_composite(df, ["a", "b"]), ["a", "b"]).collect()}
    out = D.filled_composite(df, ["a", "b"])
    got = {tuple(x[:3]): x for x in out.collect()}
    assert got.keys() == want.keys()
    for k, x in got.items():
        for c in ("a", "b"):
            assert (x[c] is None) == (want[k][c] is None) and (x[c] is None or abs(x[c] - want[k][c]) < 1e-12)
    again = D.filled_composite(df, ["a", "b"], ends=(datetime.date(2023, 12, 1), datetime.date(2024, 3, 31)))
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert not D.filled_composite(df.limit(0), ["a"]).collect()
