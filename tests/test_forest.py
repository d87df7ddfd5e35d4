"""Forests of many scenes against trees that a plain loop grows split by split, scene by scene, with the same draws."""

import math

import numpy as np
import pytest

from thermaspark.operators import forest, sharpen


def plain_tree(x, y, w, times, features, max_leaves, min_rows):
    """Best-first growth: the leaf whose best split lowers the weighted squared error most is split next."""

    def best(rows):
        own = [i for i in rows if times[i]]
        found = (0.0, None, None)
        error = lambda some: sum(times[i] * w[i] * (y[i] - np.average([y[j] for j in some], weights=[times[j] * w[j] for j in some])) ** 2 for i in some)
        for f in features:
            values = sorted({x[i][f] for i in own})
            for a, b in zip(values, values[1:], strict=False):
                left, right = [i for i in own if x[i][f] <= (a + b) / 2], [i for i in own if x[i][f] > (a + b) / 2]
                if min(len(left), len(right)) >= min_rows:
                    gain = error(own) - error(left) - error(right)
                    if gain > found[0] + 1e-9 * abs(found[0]) + 1e-12:
                        found = (gain, f, (a + b) / 2)
        return found

    leaves = [(list(range(len(y))), best(range(len(y))))]
    while len(leaves) < max_leaves:
        k = max(range(len(leaves)), key=lambda i: leaves[i][1][0])
        rows, (gain, f, cut) = leaves[k]
        if f is None:
            break
        parts = [[i for i in rows if x[i][f] <= cut], [i for i in rows if x[i][f] > cut]]
        leaves[k : k + 1] = [(p, best(p)) for p in parts]
    return [rows for rows, _ in leaves]


def plain_ridge(x, y):
    """Evidence maximisation on the rows themselves."""
    xc, yc = x - x.mean(0), y - y.mean()
    noise, precision, old = 1 / (y.var() + np.finfo(float).eps), 1.0, None
    for _ in range(300):
        coef = np.linalg.solve(noise * xc.T @ xc + precision * np.eye(x.shape[1]), noise * xc.T @ yc)
        e = np.maximum(np.linalg.eigvalsh(noise * xc.T @ xc), 0)
        known = (e / (precision + e)).sum()
        precision = (known + 2e-6) / (coef @ coef + 2e-6)
        noise = (len(y) - known + 2e-6) / (((yc - xc @ coef) ** 2).sum() + 2e-6)
        if old is not None and np.abs(coef - old).sum() < 1e-3:
            break
        old = coef
    coef = np.linalg.solve(noise * xc.T @ xc + precision * np.eye(x.shape[1]), noise * xc.T @ yc)
    return coef, y.mean() - coef @ x.mean(0)


FEATURES = ["b04", "b08", "alt"]


def scene(seed, n):
    r = np.random.default_rng(seed)
    x = np.round(r.random((n, 3)), 2)
    y = 290 + np.where(x[:, 0] > 0.5, 12 * x[:, 1], -5 * x[:, 2]) + 3 * x[:, 0] + seed + r.normal(0, 0.2, n)
    return [(seed, i // 10, i % 10, *map(float, x[i]), float(y[i]), float(0.5 + r.random())) for i in range(n)]


@pytest.fixture(scope="module")
def samples(spark):
    rows = scene(1, 90) + scene(2, 120) + scene(3, 1) + scene(4, 12)
    return spark.createDataFrame(rows, "scene int, row int, col int, b04 double, b08 double, alt double, lst double, weight double").withColumn("extra", __import__("pyspark").sql.functions.lit("x")).repartition(5)


OPTIONS = forest.Options(trees=3, max_leaves=6, min_rows=7, seed=5)


@pytest.fixture(scope="module")
def models(samples):
    return forest.fit(samples, ["scene"], FEATURES, ["scene", "row", "col"], options=OPTIONS)


def test_trees_and_lines_equal_plain_ones(samples, models):
    from pyspark.sql import functions as F

    got = {r["scene"]: r for r in models.collect()}
    assert sorted(got) == [1, 2, 3, 4]
    grown = 0
    for s in got:
        rows = samples.filter(F.col("scene") == s).select("*", F.xxhash64("scene", "row", "col").alias("id")).collect()
        x, y, w = (np.array([[r[f] for f in FEATURES] for r in rows]), np.array([r["lst"] for r in rows]), np.array([r["weight"] for r in rows]))
        drawn = OPTIONS.drawn_rows(np.array([r["id"] for r in rows]), len(rows))
        for t, features in enumerate(OPTIONS.drawn_features(3)):
            leaves = plain_tree(x, y, w, drawn[t], features.tolist(), 6, 7)
            grown += len(leaves) > 3
            lines = {r["leaf"]: r for r in got[s]["lines"] if r["tree"] == t}
            assert len(lines) == len(leaves)
            nodes = {r["node"]: r for r in got[s]["trees"] if r["tree"] == t}
            for own in leaves:
                at = set()
                for i in own:
                    node = 0
                    while nodes[node]["feature"] >= 0:
                        node = nodes[node]["left"] if x[i][nodes[node]["feature"]] <= nodes[node]["cut"] else nodes[node]["right"]
                    at.add(node)
                assert len(at) == 1
                line = lines[at.pop()]
                coef, start = plain_ridge(x[own][:, features], y[own])
                assert np.allclose(np.array(line["coef"])[features], coef, atol=1e-6) and math.isclose(line["intercept"], start, abs_tol=1e-6)
                assert line["ymin"] == y[own].min() and line["ymax"] == y[own].max()
    assert grown > 2


def test_scenes_together_equal_scenes_alone(spark, samples, models):
    cells = spark.createDataFrame([(s, r, c, (r * 7 + c) % 13 / 13, (r + 3 * c) % 11 / 11, None if (r, c) == (0, 0) else (r * c) % 7 / 7) for s in (1, 2, 9) for r in range(12) for c in range(9)], "scene int, row int, col int, b04 double, b08 double, alt double")
    both = {(r["scene"], r["row"], r["col"]): r["lst"] for r in forest.apply(cells, models, ["scene"], FEATURES, side=5).collect()}
    assert len(both) == 216 and all((lst is None) == (r == c == 0) for (_, r, c), lst in both.items())
    plain = {(r["scene"], r["row"], r["col"]): r["lst"] for r in forest.apply(cells, models, ["scene"], FEATURES, plain=True).collect()}
    assert all(v is None or 270 < v < 320 for v in plain.values())
    for s in (1, 2):
        one = forest.fit(samples.filter(f"scene = {s}"), ["scene"], FEATURES, ["scene", "row", "col"], options=OPTIONS)
        alone = {(s, r["row"], r["col"]): r["lst"] for r in forest.apply(cells.filter(f"scene = {s}"), one, ["scene"], FEATURES).collect()}
        assert all(alone[k] == both[k] or abs(alone[k] - both[k]) < 1e-9 for k in alone)


def test_scenes_without_samples_are_named(spark, models):
    scenes = spark.createDataFrame([(1,), (2,), (9,), (9,)], "scene int")
    assert [r["scene"] for r in sharpen.unusable_scenes(scenes, models, ["scene"]).collect()] == [9]


def test_draws_follow_from_the_seed():
    ids = np.arange(20_000)
    one, other = forest.Options(seed=1).drawn_rows(ids, 20_000), forest.Options(seed=2).drawn_rows(ids, 20_000)
    assert (one == forest.Options(seed=1).drawn_rows(ids, 20_000)).all() and (one != other).any()
    assert abs(one.mean() - 0.8) < 0.01 and abs(one.var() - 0.8) < 0.02
    assert [len(f) for f in forest.Options(trees=2).drawn_features(11)] == [8, 8]


def test_no_samples_at_all(spark, samples):
    assert not forest.fit(samples.limit(0), ["scene"], FEATURES, ["row", "col"], options=OPTIONS).collect()
