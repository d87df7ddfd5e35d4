"""Thermal sharpening: for every scene a bagged forest with a line in every leaf, fitted on coarse cells and applied to fine ones."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import forest
from .grid import CROSS, aggregate_to_lowres, steady_to_lowres
from .quantiles import group_quantiles

def training_samples(fine: DataFrame, low: DataFrame, bands: Sequence[str], factor: int, cv_max: float = 0.8, keys: Sequence[str] = ()) -> DataFrame:
    """Coarse cells with good quality, temperature and features, and a weight of 1 / CV, the mean over bands of deviation over mean.

    Without a cv_max it is found, and is as a rule the CV of some cells. These are left out with all that are like them, so
    that CVs must not differ by the order in which rows were added.
    """
    means = (aggregate_to_lowres if cv_max > 0 else steady_to_lowres)(fine, factor, bands, keys)
    nonzero = lambda b: F.when(F.col(f"{b}_mean") == 0, 1e-6).otherwise(F.col(f"{b}_mean"))
    cv = sum((F.col(f"{b}_std") / nonzero(b) for b in bands), F.lit(0.0)) / len(bands)
    out = means.join(low, [*keys, "row", "col"]).withColumn("cv", F.coalesce(cv, F.lit(1000.0)))
    limit = F.lit(cv_max)
    if cv_max <= 0:
        good = group_quantiles(out.filter("quality = 1 AND cv > 0 AND cv < 1000"), F.col("cv"), (0.8,)).select(F.col("q")[0].alias("q"))
        auto = good.agg(F.coalesce(F.max("q"), F.lit(0.0)).alias("__limit"))
        out, limit = out.crossJoin(F.broadcast(auto)), F.col("__limit")
    good = (F.col("quality") == 1) & F.col("lst").isNotNull() & (F.col("cv") > 0) & (F.col("cv") < limit)
    for b in bands:
        good = good & F.col(f"{b}_mean").isNotNull()
    return out.filter(good).select(*keys, "row", "col", "lst", "cv", (1 / F.col("cv")).alias("weight"), *(F.col(f"{b}_mean").alias(b) for b in bands))


def fit_sharpener(samples: DataFrame, features: Sequence[str], keys: Sequence[str] = (), trees: int = 30, seed: int = 0, cell: Sequence[str] = ("row", "col")) -> DataFrame:
    """keys, trees, lines: for every scene, told apart by `keys`, a bagged forest of its own with a line in every leaf.

    A tree draws 0.8 of the rows and of the features, grows best first to 30 leaves of at least 10 drawn rows, splitting by
    weighted squared error; a leaf's Bayesian ridge line goes through all rows that fall into it, unweighted.
    """
    if not keys:
        return fit_sharpener(samples.withColumn("scene", F.lit(0)), features, ["scene"], trees, seed, cell)
    return forest.fit(samples, keys, features, [*keys, *cell], options=forest.Options(trees=trees, seed=seed))


def apply_sharpener(fine: DataFrame, models: DataFrame, features: Sequence[str], keys: Sequence[str] = (), margin: float = 0.25, plain: bool = False) -> DataFrame:
    """keys, row, col, lst: the mean over trees of the leaf's line, clamped to its range and a quarter more; cells with a missing feature are missing.

    `plain` takes the leaves' own values. Scenes without a model have no rows; unusable_scenes() names them.
    """
    if not keys:
        return apply_sharpener(fine.withColumn("scene", F.lit(0)), models, features, ["scene"], margin, plain).drop("scene")
    return forest.apply(fine, models, keys, features, margin, plain)


def unusable_scenes(scenes: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scenes that gave no sample to train on, so that they are left out."""
    return scenes.select(*keys).distinct().join(models.select(*keys), list(keys), "left_anti")


def trained_scenes(scenes: DataFrame, samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n, usable: every scene with the number of its samples."""
    counts = samples.groupBy(*keys).agg(F.count("*").alias("n"))
    out = scenes.select(*keys).distinct().join(counts, list(keys), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("usable", F.col("n") > 0)


#: Coarse cells a side of a window, and those around it that a residual depends on: smoothing one, bilinear weights one, filled gaps one.
SIDE, HALO = 35, 3
#: Kinds of rows in a window.
COARSE, FINE, ENDS = 0, 1, 2


def _padded(values: np.ndarray) -> np.ndarray:
    out = np.zeros((values.shape[0] + 2, values.shape[1] + 2), values.dtype)
    out[1:-1, 1:-1] = values
    return out


def _smoothed(own: np.ndarray, known: np.ndarray, edges: Sequence[bool]) -> np.ndarray:
    """3 by 3 weights 1-2-1 by 1-2-1 around known cells; beyond those of the four edges that are the scene's lies the edge cell again."""
    sums = []
    for v in (_padded(np.where(known, own, 0.0)), _padded(known.astype(float))):
        for edge, at, of in zip(edges, (np.s_[0], np.s_[-1], np.s_[:, 0], np.s_[:, -1]), (np.s_[1], np.s_[-2], np.s_[:, 1], np.s_[:, -2])):
            if edge:
                v[at] = v[of]
        v = v[:-2] + 2 * v[1:-1] + v[2:]
        sums.append(v[:, :-2] + 2 * v[:, 1:-1] + v[:, 2:])
    return sums[0] / np.where(sums[1] > 0, sums[1], 1.0)


def _linear(n: int, factor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the fine places along n coarse ones the two that they lie between, in padded cells, and the weight of the second. Where that is 0, both are the first."""
    f = (np.arange(n * factor) + 0.5) / factor - 0.5
    first = np.floor(f).astype(int)
    part = f - first
    return first + 1, first + 1 + (part > 0), part


def _bilinear(own: np.ndarray, known: np.ndarray, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """On all fine cells the value and whether there is one; missing neighbours are left out and weights renormalised."""
    (r0, r1, pr), (c0, c1, pc) = (_linear(n, factor) for n in own.shape)
    sums = []
    for v in (_padded(np.where(known, own, 0.0)), _padded(known.astype(float))):
        v = v[r0] * (1 - pr)[:, None] + v[r1] * pr[:, None]
        sums.append(v[:, c0] * (1 - pc) + v[:, c1] * pc)
    return sums[0] / np.where(sums[1] > 0, sums[1], 1.0), sums[1] > 0


def _filled(values: np.ndarray, known: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Missing cells whose four neighbours are cells of the scene take the mean of those that have a value."""
    if known[present].all():
        return values, known
    h, w = values.shape
    v, k, p = _padded(np.where(known, values, 0.0)), _padded(known & present), _padded(present)
    cross = [(slice(1 + r, 1 + r + h), slice(1 + c, 1 + c + w)) for r, c in CROSS]
    total, n, cells = (sum(x[at] for at in cross) for x in (np.where(k, v, 0.0), k.astype(int), p.astype(int)))
    gap = ~known & (cells == 4) & (n > 0)
    return np.where(gap, total / np.maximum(n, 1), values), known | gap


def _window_residuals(kind: np.ndarray, row: np.ndarray, col: np.ndarray, value: np.ndarray, known: np.ndarray, factor: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residuals of the rows `own`, fine cells of a window that has all cells around it, and whether they are known."""
    fine, ends = kind == FINE, np.sort(np.stack([row[kind == ENDS], col[kind == ENDS]], 1), 0)
    r, c, v, k = row[fine], col[fine], value[fine], known[fine]
    cr, cc = r // factor, c // factor
    r0, c0, h, w = cr.min(), cc.min(), cr.max() - cr.min() + 1, cc.max() - cc.min() + 1
    at = (cr - r0) * w + cc - c0
    n, total = np.bincount(at[k], minlength=h * w), np.bincount(at[k], v[k], minlength=h * w)
    good = (kind == COARSE) & known & (row >= r0) & (row < r0 + h) & (col >= c0) & (col < c0 + w)
    low, met = np.zeros(h * w), np.zeros(h * w, bool)
    place = (row[good] - r0) * w + col[good] - c0
    low[place], met[place] = value[good], True
    met &= n > 0
    residual, met = (low - total / np.maximum(n, 1)).reshape(h, w), met.reshape(h, w)
    smooth = _smoothed(residual, met, (r0 == ends[0, 0], r0 + h - 1 == ends[1, 0], c0 == ends[0, 1], c0 + w - 1 == ends[1, 1]))
    present = np.zeros((h * factor, w * factor), bool)
    present[r - r0 * factor, c - c0 * factor] = True
    out, there = _filled(*_bilinear(smooth, met, factor), present)
    place = row[own] - r0 * factor, col[own] - c0 * factor
    return out[place], there[place]


def _starts(rows: pa.RecordBatch, keys: Sequence[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Rows whose keys differ from those of the row before them; `before` ends with the one before the first."""
    both = rows.select(keys) if before is None else pa.Table.from_batches([before.slice(before.num_rows - 1).select(keys), rows.select(keys)]).combine_chunks().to_batches()[0]
    ends = [pc.run_end_encode(c).run_ends.to_numpy()[:-1] for c in both.columns]
    return np.unique(np.concatenate(ends)) - (before is not None)


def scene_residuals(fine: DataFrame, low: DataFrame, factor: int, keys: Sequence[str] = (), power: int = 4, side: int = SIDE) -> DataFrame:
    """Per fine cell keys, row, col, `raised`, its temperature in fourth powers (power 1: as it is), and `residual` as of smoothed_residuals().

    Cells of both grids are dealt by one shuffle to windows of `side` coarse cells a side, each with the cells around it;
    with them go the ends of the scene, which may have any extent. A task reads its windows one after another.
    """
    # windows begin HALO cells before cell 0, so that a scene that begins there is in no window before it
    window = lambda c, cell, shift: F.floor((F.col(c) + shift * cell) / (side * cell)).cast("int")
    own = [window(c, factor, HALO).alias(a) for c, a in (("row", "wr"), ("col", "wc"))]

    def dealt(df: DataFrame, kind: int, cell: int, value: Column) -> DataFrame:
        reach = lambda c: F.explode(F.sequence(window(c, cell, 0), window(c, cell, 2 * HALO)))
        at = df.select(*keys, F.lit(kind).alias("kind"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), value.alias("raised"), reach("row").alias("wr"))
        return at.withColumn("wc", reach("col"))

    raised = F.pow(F.col("lst"), F.lit(power))
    coarse = lambda c: F.floor(F.col(c) / factor).cast("int")
    corners = [(f, n, c) for f, n in ((F.min, "first"), (F.max, "last")) for c in ("row", "col")]
    # temperatures are counted so that both readings of `fine` ask for the same columns, and Spark makes and shuffles them once
    ends = fine.groupBy(*keys, *own).agg(*(f(coarse(c)).alias(f"{n}_{c}") for f, n, c in corners), F.count("lst").cast("double").alias("raised"))
    ends = ends.select(*keys, "wr", "wc", "raised", *(f(f"{n}_{c}").over(Window.partitionBy(*keys)).alias(f"{n}_{c}") for f, n, c in corners))
    at = F.explode(F.array(*(F.struct(F.col(f"{n}_row").alias("row"), F.col(f"{n}_col").alias("col")) for n in ("first", "last")))).alias("at")
    ends = ends.select(*keys, "wr", "wc", "raised", at).select(*keys, F.lit(ENDS).alias("kind"), "at.row", "at.col", "raised", "wr", "wc")
    cells = dealt(fine, FINE, factor, raised).unionByName(dealt(low.filter("quality = 1"), COARSE, 1, raised)).unionByName(ends)

    def solved(rows: pa.Table, starts: Sequence[int]) -> Iterator[pa.RecordBatch]:
        kind, row, col, wr, wc, value = (rows.column(c).to_numpy() for c in ("kind", "row", "col", "wr", "wc", "raised"))
        known, size, shift = rows.column("raised").is_valid().to_numpy(), side * factor, HALO * factor
        own = (kind == FINE) & ((row + shift) // size == wr) & ((col + shift) // size == wc)
        residual, there = np.zeros(len(own)), np.zeros(len(own), bool)
        for i, j in zip(starts, [*starts[1:], len(own)]):
            if own[i:j].any():
                at = slice(i, j)
                residual[at][own[at]], there[at][own[at]] = _window_residuals(kind[at], row[at], col[at], value[at], known[at], factor, own[at])
        out = rows.select([*keys, "row", "col", "raised"]).filter(pa.array(own))
        yield from out.append_column("residual", pa.array(residual[own], pa.float64(), mask=~there[own])).combine_chunks().to_batches()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # of the window that the last batch ended in
        for b in batches:
            starts = _starts(b, [*keys, "wr", "wc"], held[-1] if held else None)
            if len(starts):
                n = sum(h.num_rows for h in held)
                if n or starts[-1]:
                    yield from solved(pa.Table.from_batches([*held, b.slice(0, starts[-1])]), [0, *(starts[:-1] + n)])
                held, b = [], b.slice(starts[-1])
            held.append(b)
        if held:
            yield from solved(pa.Table.from_batches(held), [0])

    head = f"{forest.types(fine, keys)}, " if keys else ""
    at = [*keys, "wr", "wc"]
    return cells.repartition(*at).sortWithinPartitions(*at).mapInArrow(each, f"{head}row int, col int, raised double, residual double")


def smoothed_residuals(fine: DataFrame, low: DataFrame, factor: int, keys: Sequence[str] = (), power: int = 4) -> DataFrame:
    """Per fine cell the residual, in fourth powers (power 1: of the values): of good coarse cells, smoothed, resampled bilinearly, gaps of one cell off the border filled.

    Of a good coarse cell it is the difference between its temperature and the mean of its fine cells. Coarse cells that are
    bad or absent have no residual and give none to their neighbours. Coarse cells are those of the fine ones, so that their
    grid reaches as far and no edge needs padding.
    """
    return scene_residuals(fine, low, factor, keys, power).select(*keys, "row", "col", "residual")


def correct_residuals(fine: DataFrame, low: DataFrame, factor: int, keys: Sequence[str] = (), power: int = 4) -> DataFrame:
    """keys, row, col, lst: correct_smoothed() with smoothed_residuals(), from one dealing of the cells."""
    return scene_residuals(fine, low, factor, keys, power).select(*keys, "row", "col", F.pow(F.col("residual") + F.col("raised"), F.lit(1 / power)).alias("lst"))


def correct_smoothed(fine: DataFrame, residual: DataFrame, keys: Sequence[str] = (), power: int = 4) -> DataFrame:
    """Fine temperatures with their own residual added in fourth powers, or as it is at power 1; without a residual they are missing."""
    met = fine.join(residual.select(*keys, "row", "col", "residual"), [*keys, "row", "col"], "left")
    return met.withColumn("lst", F.pow(F.col("residual") + F.pow("lst", F.lit(power)), F.lit(1 / power))).drop("residual")


def residual_stats(residual: DataFrame) -> DataFrame:
    """bias and rmsd of the residuals as temperatures around 273.15 K."""
    t = residual.select((F.pow(F.col("residual") + 273.15**4, F.lit(0.25)) - 273.15).alias("t"))
    return t.agg(F.avg("t").alias("bias"), F.sqrt(F.avg(F.col("t") * F.col("t"))).alias("rmsd"))
