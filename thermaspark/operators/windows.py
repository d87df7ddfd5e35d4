"""Windows of a coarse and a fine grid that cover the same ground, dealt to tasks once with the cells around them.

A neighbourhood step in SQL explodes cells to their neighbours and shuffles them. A chain of such steps over windows that
bring their border along needs one shuffle: every cell goes to its own window and to those whose border it belongs to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .forest import Model, predict, types
from .grid import Grid


@dataclass(frozen=True)
class Windows:
    """`rows` by `cols` coarse cells a window, the last ones smaller; each coarse cell is `factor` by `factor` fine ones, the last ones fewer."""

    coarse: Grid
    fine: Grid
    factor: int
    rows: int = 35
    cols: int = 35

    def __post_init__(self):
        """The same number of windows has to cover both grids."""
        pairs = [(self.coarse.n_rows, self.rows, self.fine.n_rows), (self.coarse.n_cols, self.cols, self.fine.n_cols)]
        if any(-(-n // size) != -(-m // (size * self.factor)) for n, size, m in pairs):
            raise ValueError("windows of the coarse and of the fine grid differ in number")

    def counts(self) -> tuple[int, int]:
        return -(-self.coarse.n_rows // self.rows), -(-self.coarse.n_cols // self.cols)


@dataclass
class Patch:
    """Part of a grid of n_rows by n_cols cells: rows from `row`, columns from `col`; NaN where there is no value."""

    values: np.ndarray
    row: int
    col: int
    n_rows: int
    n_cols: int

    def at_edges(self) -> np.ndarray:
        """The values with one more cell on every side: the edge cell again at the grid's edges, NaN elsewhere."""
        out = np.pad(self.values, 1, constant_values=np.nan)
        (r, c), (h, w) = (self.row, self.col), self.values.shape
        for at, into, edge in ((out[0], out[1], r == 0), (out[-1], out[-2], r + h == self.n_rows)):
            if edge:
                at[:] = into
        for at, into, edge in ((out[:, 0], out[:, 1], c == 0), (out[:, -1], out[:, -2], c + w == self.n_cols)):
            if edge:
                at[:] = into
        return out

    def like(self, values: np.ndarray) -> Patch:
        return Patch(values, self.row, self.col, self.n_rows, self.n_cols)


def shifts(padded: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    h, w = padded.shape[0] - 2, padded.shape[1] - 2
    for dr in (-1, 0, 1):
        for dc in (-1, 0, 1):
            yield dr, dc, padded[1 + dr : 1 + dr + h, 1 + dc : 1 + dc + w]


def smoothed(p: Patch) -> Patch:
    """3 by 3 weights 1-2-1 by 1-2-1; missing centres stay missing, missing neighbours are left out."""
    total, weight = np.zeros(p.values.shape), np.zeros(p.values.shape)
    for dr, dc, v in shifts(p.at_edges()):
        w, known = (2 - abs(dr)) * (2 - abs(dc)), ~np.isnan(v)
        total += np.where(known, w * v, 0.0)
        weight += np.where(known, w, 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return p.like(np.where(np.isnan(p.values), np.nan, total / weight))


def filled(p: Patch) -> Patch:
    """Missing cells off the grid's border take the mean of their valid 4-neighbours."""
    near = [v for dr, dc, v in shifts(np.pad(p.values, 1, constant_values=np.nan)) if abs(dr) + abs(dc) == 1]
    known = sum((~np.isnan(v)).astype(int) for v in near)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = sum(np.nan_to_num(v) for v in near) / known
    r, c = p.row + np.arange(p.values.shape[0])[:, None], p.col + np.arange(p.values.shape[1])[None, :]
    inside = (r > 0) & (r < p.n_rows - 1) & (c > 0) & (c < p.n_cols - 1)
    return p.like(np.where(np.isnan(p.values) & inside & (known > 0), mean, p.values))


def terrain(p: Patch, cell_x: float, cell_y: float) -> tuple[Patch, Patch]:
    """Slope (rise over run) and aspect (radians, clockwise from north) by Horn's differences; border cells are missing."""
    gx, gy, whole = np.zeros(p.values.shape), np.zeros(p.values.shape), np.ones(p.values.shape, bool)
    good = np.where(p.values >= -10000, p.values, np.nan)
    for dr, dc, v in shifts(np.pad(good, 1, constant_values=np.nan)):
        whole &= ~np.isnan(v)
        gx += dc * (2 - abs(dr)) * np.nan_to_num(v) / (8 * cell_x)
        gy += dr * (2 - abs(dc)) * np.nan_to_num(v) / (8 * cell_y)
    slope, aspect = np.hypot(gx, gy), np.mod(np.arctan2(-gx, gy), 2 * np.pi)
    return p.like(np.where(whole, slope, np.nan)), p.like(np.where(whole & (slope != 0), aspect, np.nan))


def bilinear(low: Patch, like: Patch, factor: int) -> Patch:
    """Coarse values on the cells of a fine patch; missing neighbours are left out and weights renormalised."""
    h, w = like.values.shape
    fr, fc = (like.row + np.arange(h) + 0.5) / factor - 0.5, (like.col + np.arange(w) + 0.5) / factor - 0.5
    total, weight = np.zeros((h, w)), np.zeros((h, w))
    padded = np.pad(low.values, 1, constant_values=np.nan)
    for i in (0, 1):
        for j in (0, 1):
            r, c = np.floor(fr).astype(int) + i, np.floor(fc).astype(int) + j
            part = np.outer(1 - np.abs(fr - r), 1 - np.abs(fc - c))
            v = padded[np.clip(r - low.row + 1, 0, low.values.shape[0] + 1)][:, np.clip(c - low.col + 1, 0, low.values.shape[1] + 1)]
            known = ~np.isnan(v) & (part > 0)
            total += np.where(known, part * np.nan_to_num(v), 0.0)
            weight += np.where(known, part, 0.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return like.like(np.where(weight > 0, total / weight, np.nan))


def coarse_means(fine: Patch, low: Patch, factor: int) -> np.ndarray:
    """The mean of a coarse patch's fine cells that have a value."""
    h, w = low.values.shape
    whole = np.full((h * factor, w * factor), np.nan)
    r, c = fine.row - low.row * factor, fine.col - low.col * factor
    whole[r : r + fine.values.shape[0], c : c + fine.values.shape[1]] = fine.values
    cells = whole.reshape(h, factor, w, factor)
    known = (~np.isnan(cells)).sum((1, 3))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.nansum(cells, (1, 3)) / np.where(known, known, np.nan)


def residual_of(hot: Patch, lst: Patch, quality: Patch, factor: int, power: int) -> Patch:
    """Of good coarse cells the difference of powers between their temperature and the mean of their fine cells, smoothed, on fine cells, gaps of one cell filled."""
    own = np.where(quality.values == 1, lst.values**power, np.nan) - coarse_means(hot.like(hot.values**power), lst, factor)
    return filled(bilinear(smoothed(lst.like(own)), hot, factor))


# -- dealing ----------------------------------------------------------------------------


def _sent(df: DataFrame, keys: Sequence[str], tag: int, bands: Sequence[str], width: int, size: tuple[int, int], halo: tuple[int, int], counts: tuple[int, int]) -> DataFrame:
    """A row for each window that a cell belongs to or borders on."""

    def windows(c: str, n: int, border: int, last: int) -> Column:
        first, final = F.floor((F.col(c) - border) / n), F.floor((F.col(c) + border) / n)
        return F.sequence(F.greatest(F.lit(0), first).cast("int"), F.least(F.lit(last - 1), final).cast("int"))

    values = [F.col(b).cast("double").alias(f"v{i}") for i, b in enumerate(bands)] + [F.lit(None).cast("double").alias(f"v{i}") for i in range(len(bands), width)]
    at = df.select(*keys, F.lit(tag).alias("tag"), "row", "col", *values, F.explode(windows("row", size[0], halo[0], counts[0])).alias("wr"))
    return at.withColumn("wc", F.explode(windows("col", size[1], halo[1], counts[1])))


def windows_of(low: DataFrame, low_bands: Sequence[str], fine: DataFrame, fine_bands: Sequence[str], keys: Sequence[str], w: Windows, halo: int) -> DataFrame:
    """keys, wr, wc and the cells of both grids in each window and `halo` coarse cells around it, dealt by one shuffle; windows without fine cells too."""
    width = max(len(low_bands), len(fine_bands))
    parts = [
        _sent(low, keys, 0, low_bands, width, (w.rows, w.cols), (halo, halo), w.counts()),
        _sent(fine, keys, 1, fine_bands, width, (w.rows * w.factor, w.cols * w.factor), (halo * w.factor, halo * w.factor), w.counts()),
    ]
    names = [f"v{i}" for i in range(width)]

    def pack(rows: pa.Table) -> pa.Table:
        data = np.stack([rows.column(c).to_numpy().astype(np.float64) for c in ("tag", "row", "col", *names)], 1)
        head = [rows.column(c).slice(0, 1).combine_chunks() for c in (*keys, "wr", "wc")]
        return pa.table([*head, pa.array([data.tobytes()], pa.binary())], names=[*keys, "wr", "wc", "data"])

    return parts[0].unionByName(parts[1]).groupBy(*keys, "wr", "wc").applyInArrow(pack, f"{types(low, keys)}, wr int, wc int, data binary")


def _patches(data: np.ndarray, tag: int, bands: Sequence[str], wr: int, wc: int, g: Grid, size: tuple[int, int], halo: int) -> tuple[dict[str, Patch], np.ndarray]:
    """The bands of one grid in a window with its border, and its own cells (positions in the patch)."""
    r0, c0 = max(0, wr * size[0] - halo), max(0, wc * size[1] - halo)
    r1, c1 = min(g.n_rows, (wr + 1) * size[0] + halo), min(g.n_cols, (wc + 1) * size[1] + halo)
    rows = data[data[:, 0] == tag]
    r, c = rows[:, 1].astype(int), rows[:, 2].astype(int)
    inside = (r >= r0) & (r < r1) & (c >= c0) & (c < c1)
    rows, r, c = rows[inside], r[inside], c[inside]
    out = {}
    for i, b in enumerate(bands):
        values = np.full((r1 - r0, c1 - c0), np.nan)
        values[r - r0, c - c0] = rows[:, 3 + i]
        out[b] = Patch(values, r0, c0, g.n_rows, g.n_cols)
    own = (r // size[0] == wr) & (c // size[1] == wc)
    return out, np.stack([r[own] - r0, c[own] - c0], 1)


Run = Callable[[dict[str, Patch], dict[str, Patch]], dict[str, Patch]]


def over_windows(low: DataFrame, low_bands: Sequence[str], fine: DataFrame, fine_bands: Sequence[str], keys: Sequence[str], w: Windows, halo: int, run: Run | Callable, out: Sequence[str], models: DataFrame | None = None) -> DataFrame:
    """keys, row, col and the bands `out` of the fine cells: run(coarse patches, fine patches) for each window, with a scene's model as a third argument if models are given.

    A chain of steps that reach n coarse cells in all needs a halo of n.
    """
    dealt = windows_of(low, low_bands, fine, fine_bands, keys, w, halo)
    width = 3 + max(len(low_bands), len(fine_bands))
    modelled = models is not None
    if modelled:
        dealt = dealt.join(models, list(keys)).select(*keys, "wr", "wc", "data", "trees", "lines")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, raw in enumerate(b.column("data").to_pylist()):
                data, wr, wc = np.frombuffer(raw, np.float64).reshape(-1, width), b.column("wr")[i].as_py(), b.column("wc")[i].as_py()
                below, _ = _patches(data, 0, low_bands, wr, wc, w.coarse, (w.rows, w.cols), halo)
                above, own = _patches(data, 1, fine_bands, wr, wc, w.fine, (w.rows * w.factor, w.cols * w.factor), halo * w.factor)
                if not len(own):
                    continue
                found = run(below, above, *([Model.read(b.column("trees")[i], b.column("lines")[i])] if modelled else []))
                r, c = own.T
                head = [b.column(k).take(pa.array(np.full(len(own), i))) for k in keys]
                first = next(iter(above.values()))
                columns = [pa.array(v, mask=np.isnan(v)) for v in (found[n].values[r, c] for n in out)]
                yield pa.RecordBatch.from_arrays([*head, pa.array((r + first.row).astype(np.int32)), pa.array((c + first.col).astype(np.int32)), *columns], names=[*keys, "row", "col", *out])

    schema = f"{types(low, keys)}, row int, col int, " + ", ".join(f"{n} double" for n in out)
    return dealt.mapInArrow(each, schema)


#: Coarse cells that residuals reach: smoothing one, bilinear weights one, filled gaps one.
RESIDUAL_HALO = 3


def correct_residuals(hot: DataFrame, low: DataFrame, keys: Sequence[str], w: Windows, power: int = 4) -> DataFrame:
    """keys, row, col, lst of fine cells with their residual added in powers of temperature; without a residual they are missing."""

    def run(below: dict[str, Patch], above: dict[str, Patch]) -> dict[str, Patch]:
        t = above["lst"]
        return {"lst": t.like((residual_of(t, below["lst"], below["quality"], w.factor, power).values + t.values**power) ** (1 / power))}

    return over_windows(low, ["lst", "quality"], hot, ["lst"], keys, w, RESIDUAL_HALO, run, ["lst"])


def sharpen(fine: DataFrame, low: DataFrame, models: DataFrame, features: Sequence[str], keys: Sequence[str], w: Windows, residual: bool = True, margin: float = 0.25, power: int = 4) -> DataFrame:
    """keys, row, col, lst: the models' temperatures and their correction by residuals, from one dealing of both grids."""

    def run(below: dict[str, Patch], above: dict[str, Patch], model: Model) -> dict[str, Patch]:
        like = above[features[0]]
        x = np.stack([above[f].values.ravel() for f in features], 1)
        whole, lst = ~np.isnan(x).any(1), np.full(len(x), np.nan)
        if whole.any():
            lst[whole] = predict(x[whole], model, margin, False)
        t = like.like(lst.reshape(like.values.shape))
        if not residual:
            return {"lst": t}
        return {"lst": t.like((residual_of(t, below["lst"], below["quality"], w.factor, power).values + t.values**power) ** (1 / power))}

    return over_windows(low, ["lst", "quality"], fine, list(features), keys, w, RESIDUAL_HALO if residual else 0, run, ["lst"], models)
