"""Sharpening against plain versions of the reference's steps, on scenes with missing and bad coarse cells."""

import itertools
import math

import pytest

from thermaspark.operators import grid as G
from thermaspark.operators import sharpen as I


def plain_correction(fine, low, factor):
    """fine: {(row, col): t}; low: {(row, col): (lst, quality)} of one scene."""
    rows, cols = max(r for r, _ in fine) + 1, max(c for _, c in fine) + 1
    nr, nc = -(-rows // factor), -(-cols // factor)
    res = {}
    for r in range(nr):
        for c in range(nc):
            own = [t**4 for (a, b), t in fine.items() if (a // factor, b // factor) == (r, c)]
            lst, quality = low.get((r, c), (None, 0))
            res[r, c] = lst**4 - sum(own) / len(own) if quality == 1 and lst is not None else None
    smooth = {}
    for r, c in res:
        near = [((2 - abs(i)) * (2 - abs(j)), res[min(nr - 1, max(0, r + i)), min(nc - 1, max(0, c + j))]) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        near = [(w, v) for w, v in near if v is not None]
        smooth[r, c] = sum(w * v for w, v in near) / sum(w for w, _ in near) if res[r, c] is not None else None
    wide = {}
    for r, c in fine:
        fr, fc = (r + 0.5) / factor - 0.5, (c + 0.5) / factor - 0.5
        near = [((1 - abs(fr - a)) * (1 - abs(fc - b)), smooth.get((a, b))) for a in (math.floor(fr), math.floor(fr) + 1) for b in (math.floor(fc), math.floor(fc) + 1)]
        near = [(w, v) for w, v in near if v is not None and w > 0]
        wide[r, c] = sum(w * v for w, v in near) / sum(w for w, _ in near) if near else None
    out = {}
    for (r, c), t in fine.items():
        v, near = wide[r, c], [wide.get(p) for p in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1))]
        if v is None and 0 < r < rows - 1 and 0 < c < cols - 1:
            near = [x for x in near if x is not None]
            v = sum(near) / len(near) if near else None
        out[r, c] = (v + t**4) ** 0.25 if v is not None else None
    return out


def test_smoothed_correction_of_two_scenes(spark):
    fine, low = [], []
    for k, (rows, cols) in enumerate([(18, 15), (10, 21)]):
        fine += [(k, r, c, 290.0 + (r * 7 + c * 3 + k) % 11) for r in range(rows) for c in range(cols)]
        # a block of bad cells, an absent one, a missing one
        low += [(k, r, c, None if (r, c) == (0, 4) else 295.0 + (r * 5 + c * 2 + k) % 7, 0 if r in (2, 3) and c in (1, 2, 3) else 1) for r in range(-(-rows // 3)) for c in range(-(-cols // 3)) if (r, c) != (1, 0)]
    f = spark.createDataFrame(fine, "k int, row int, col int, lst double")
    q = spark.createDataFrame(low, "k int, row int, col int, lst double, quality int")
    got = {(x["k"], x["row"], x["col"]): x["lst"] for x in I.correct_smoothed(f, I.smoothed_residuals(f, q, 3, ["k"]), ["k"]).collect()}
    assert len(got) == len(fine)
    missing = 0
    for k in (0, 1):
        want = plain_correction({(r, c): t for a, r, c, t in fine if a == k}, {(r, c): (t, g) for a, r, c, t, g in low if a == k}, 3)
        for (r, c), t in want.items():
            missing += t is None
            assert (got[k, r, c] is None) == (t is None) and (t is None or abs(got[k, r, c] - t) < 1e-6)
    assert missing
    one = f.filter("k = 1").drop("k")
    alone = I.correct_smoothed(one, I.smoothed_residuals(one, q.filter("k = 1").drop("k"), 3)).collect()
    assert len(alone) == 210 and all(x["lst"] == got[1, x["row"], x["col"]] or abs(x["lst"] - got[1, x["row"], x["col"]]) < 1e-6 for x in alone)


def test_sharpening_covers_all_dates(spark):
    from thermaspark.fixtures import fixture
    from thermaspark.plans import catalogue

    from .conftest import DATA

    cells = fixture(spark, DATA, "s2_obs").select("acq_date", "row_hr", "col_hr").distinct().count()
    assert cells > 400
    found = catalogue.QUERIES["i3_i4_sharpen"](spark, DATA)
    assert found.filter("lst between 250 and 350").count() == cells == found.select("acq_date", "row", "col").distinct().count()
    corrected = catalogue.QUERIES["i6_i7_smoothed_correction"](spark, DATA)
    assert corrected.select("acq_date", "row", "col").distinct().count() == cells


def odd_scenes():
    """Scenes of several windows: one begins at a cell below 0, one far from 0, one has holes; gaps of one cell and wider."""
    fine, low = {}, {}
    for k, (r0, c0, rows, cols) in enumerate([(-6, 0, 24, 18), (300, 90, 21, 33), (0, 0, 17, 22)]):
        for r in range(r0, r0 + rows):
            for c in range(c0, c0 + cols):
                if k < 2 or (r * 5 + c) % 13 and not (4 <= r < 9 and 6 <= c < 9):
                    fine[k, r, c] = None if (r * c + r) % 37 == 5 else 290.0 + (r * 7 + c * 3 + k) % 11
        for r in range(r0 // 3 - 1, (r0 + rows) // 3 + 2):
            for c in range(c0 // 3 - 1, (c0 + cols) // 3 + 2):
                if (r * 3 + c) % 8:
                    low[k, r, c] = (None if (r + c) % 9 == 4 else 295.0 + (r * 5 + c * 2 + k) % 7, 0 if (r * r + c) % 6 in (1, 2) else 1)
    return fine, low


def plain_residuals(fine, low, factor, power):
    """Of one scene, whose cells may lie anywhere: {(row, col): residual}."""
    res = {}
    for r, c in {(r // factor, c // factor) for r, c in fine}:
        own = [t**power for (a, b), t in fine.items() if (a // factor, b // factor) == (r, c) and t is not None]
        lst, quality = low.get((r, c), (None, 0))
        res[r, c] = lst**power - sum(own) / len(own) if quality == 1 and lst is not None and own else None
    ends = [(min(p[i] for p in res), max(p[i] for p in res)) for i in (0, 1)]
    at = lambda p: tuple(min(hi, max(lo, x)) for x, (lo, hi) in zip(p, ends))
    mean = lambda near: sum(w * v for w, v in near if v is not None) / sum(w for w, v in near if v is not None) if any(v is not None for _, v in near) else None
    smooth = {(r, c): v if v is None else mean([((2 - abs(i)) * (2 - abs(j)), res.get(at((r + i, c + j)))) for i in (-1, 0, 1) for j in (-1, 0, 1)]) for (r, c), v in res.items()}
    wide = {}
    for r, c in fine:
        fr, fc = (r + 0.5) / factor - 0.5, (c + 0.5) / factor - 0.5
        near = [((1 - abs(fr - a)) * (1 - abs(fc - b)), smooth.get((a, b))) for a in (math.floor(fr), math.floor(fr) + 1) for b in (math.floor(fc), math.floor(fc) + 1)]
        wide[r, c] = mean([(w, v) for w, v in near if w > 0])
    cross = lambda r, c: [(r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)]
    return {p: v if v is not None or not all(q in wide for q in cross(*p)) else mean([(1, wide[q]) for q in cross(*p)]) for p, v in wide.items()}


@pytest.mark.parametrize("side,power", [(35, 4), (1, 1), (2, 4), (3, 1)])
def test_residuals_of_scenes_anywhere(spark, side, power):
    fine, low = odd_scenes()
    f = spark.createDataFrame([(*p, t) for p, t in fine.items()], "k int, row int, col int, lst double").repartition(3)
    q = spark.createDataFrame([(*p, *v) for p, v in low.items()], "k int, row int, col int, lst double, quality int").repartition(2)
    found = I.scene_residuals(f, q, 3, ["k"], power, side).collect()
    got = {(x["k"], x["row"], x["col"]): x["residual"] for x in found}
    assert len(found) == len(got) and got.keys() == fine.keys()
    filled = 0
    for k in (0, 1, 2):
        want = plain_residuals({(r, c): t for (a, r, c), t in fine.items() if a == k}, {(r, c): v for (a, r, c), v in low.items() if a == k}, 3, power)
        for p, v in want.items():
            filled += v is not None
            assert (got[k, *p] is None) == (v is None) and (v is None or abs(got[k, *p] - v) <= 1e-9 * max(1.0, abs(v))), (k, p)
    assert 0 < filled < len(fine)
    if side == 35:
        whole = {(x["k"], x["row"], x["col"]): x["residual"] for x in I.smoothed_residuals(f, q, 3, ["k"], power).collect()}
        assert whole == got


def test_not_a_number_spreads_and_is_not_missing(spark):
    """As in SQL: a coarse temperature that is no number takes the cells around it along."""
    f = spark.createDataFrame([(r, c, 290.0) for r in range(12) for c in range(12)], "row int, col int, lst double")
    q = spark.createDataFrame([(r, c, float("nan") if (r, c) == (0, 0) else 295.0, 1) for r in range(6) for c in range(6)], "row int, col int, lst double, quality int")
    got = {(x["row"], x["col"]): x["lst"] for x in I.correct_residuals(f, q, 2).collect()}
    assert all(math.isnan(got[r, c]) == (r < 5 and c < 5) for r in range(12) for c in range(12))
    assert abs(got[11, 11] - 295.0) < 1e-9


def test_residuals_shuffle_cells_once(spark):
    """Steps that met their neighbours by joins and groups shuffled cells anew for each step."""
    fine, low = odd_scenes()
    f = spark.createDataFrame([(*p, t) for p, t in fine.items()], "k int, row int, col int, lst double")
    q = spark.createDataFrame([(*p, *v) for p, v in low.items()], "k int, row int, col int, lst double, quality int")
    plan = I.smoothed_residuals(f, q, 3, ["k"])._jdf.queryExecution().executedPlan().toString()
    # the ends of scenes are summed up before their two shuffles
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("rows", [1, 7, 500])
def test_windows_that_go_on_in_the_next_batch(spark, rows):
    fine, low = odd_scenes()
    f = spark.createDataFrame([(*p, t) for p, t in fine.items()], "k int, row int, col int, lst double")
    q = spark.createDataFrame([(*p, *v) for p, v in low.items()], "k int, row int, col int, lst double, quality int")
    found = lambda: sorted(tuple(x) for x in I.smoothed_residuals(f, q, 3, ["k"]).fillna(-1e9).collect())
    want = found()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        assert all(a[:3] == b[:3] and abs(a[3] - b[3]) <= 1e-9 * abs(b[3]) for a, b in zip(found(), want, strict=True))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_found_threshold_leaves_out_all_cells_that_are_like_it(spark):
    """Coarse cells of the same values in every order of rows: they have one CV, which is the threshold."""
    same, low = [0.2366, 0.2383, 0.2706, 0.2723], [0.5, 0.5, 0.51, 0.5]
    cells = [*itertools.permutations(same), *itertools.permutations(low)][:30]
    rows = [(2 * k + i // 2, i % 2, v) for k, values in enumerate(cells) for i, v in enumerate(values)]
    fine = spark.createDataFrame(rows, "row int, col int, b double").coalesce(1)
    temperature = spark.createDataFrame([(k, 0, 300.0, 1) for k in range(len(cells))], "row int, col int, lst double, quality int")
    got = I.training_samples(fine, temperature, ["b"], 2, 0.0).collect()
    assert {x["row"] for x in got} == set(range(24, 30)) and len({x["cv"] for x in got}) == 1


def test_steady_means_are_those_of_any_order(spark):
    rows = [(0, c, v) for c, v in enumerate((0.1, None, 0.1, 0.1))] + [(2, c, None) for c in range(4)] + [(4, c, 1e8 + c) for c in range(4)]
    cells = spark.createDataFrame(rows, "row int, col int, b double")
    got, want = ({x["row"]: (x["b_mean"], x["b_std"]) for x in f(cells, (2, 4), ["b"]).collect()} for f in (G.steady_to_lowres, G.aggregate_to_lowres))
    # flat cells have no deviation at all, or they would train
    assert got[0][1] == 0 and got[1] == want[1] == (None, None)
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in (0, 2))
