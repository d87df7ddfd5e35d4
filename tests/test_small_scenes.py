"""Scenes whose samples fill one block are grown by one task; by the same rules as larger ones by jobs."""

import numpy as np
import pytest

from thermaspark.operators import forest

from .test_forest import FEATURES, scene

KEYS = ["scene", "row", "col"]


@pytest.fixture(scope="module")
def samples(spark):
    rows = scene(1, 90) + scene(2, 260) + scene(3, 1) + scene(4, 12)
    return spark.createDataFrame(rows, "scene int, row int, col int, b04 double, b08 double, alt double, lst double, weight double").repartition(3)


def test_small_scenes_need_no_rounds_of_jobs(samples, monkeypatch):
    own, seen = forest.staged, []
    monkeypatch.setattr(forest, "staged", lambda df, name: (seen.append(name), own(df, name))[1])
    assert forest.fit(samples, ["scene"], FEATURES, KEYS, options=forest.Options(trees=2)).count() == 4
    assert "models" not in seen


@pytest.mark.parametrize("max_leaves", [4, 30])
def test_task_and_jobs_grow_the_same_trees(samples, monkeypatch, max_leaves):
    options = forest.Options(trees=3, max_leaves=max_leaves, min_rows=4, seed=2)
    here = {r["scene"]: r for r in forest.fit(samples, ["scene"], FEATURES, KEYS, options=options).collect()}
    monkeypatch.setattr(forest, "BLOCK_ROWS", 50)
    there = {r["scene"]: r for r in forest.fit(samples, ["scene"], FEATURES, KEYS, options=options).collect()}
    assert sorted(here) == sorted(there) == [1, 2, 3, 4]
    for s in here:
        for part, whole in (("trees", ("tree", "node", "feature", "left", "right")), ("lines", ("tree", "leaf"))):
            a, b = (sorted(m[s][part], key=lambda r: r[:2]) for m in (here, there))
            assert [[r[c] for c in whole] for r in a] == [[r[c] for c in whole] for r in b]
            rest = [c for c in a[0].asDict() if c not in whole]
            for c in rest:
                assert np.allclose([r[c] for r in a], [r[c] for r in b], rtol=1e-9, atol=1e-9)
    assert len(here[2]["lines"]) > 9
