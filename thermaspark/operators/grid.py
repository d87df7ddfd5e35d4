"""Grids: index maps, regridding, neighbourhoods.

All resampling is one pattern: the neighbours of a target cell are computed, exploded and met by an equi-join on row
and column, then reduced by weighted sums. Neighbour indices are arithmetic, so nothing is compared with everything.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Cell (row, col) spans x0 + col*dx .. x0 + (col+1)*dx, and y alike; dy is negative for north-up grids."""

    x0: float
    dx: float
    y0: float
    dy: float
    n_cols: int
    n_rows: int

    def rowcol(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.floor((y - self.y0) / self.dy).cast("int"), F.floor((x - self.x0) / self.dx).cast("int")

    def rowcol_up(self, x: Column, y: Column) -> tuple[Column, Column]:
        """The next row and column rather than the last one begun; equal to rowcol() on a cell's edge."""
        return F.ceil((y - self.y0) / self.dy).cast("int"), F.ceil((x - self.x0) / self.dx).cast("int")

    def fraction(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column with fractions, 0 at the centre of cell 0."""
        return (y - self.y0) / self.dy - 0.5, (x - self.x0) / self.dx - 0.5

    def centre(self, row: Column, col: Column) -> tuple[Column, Column]:
        return self.x0 + (col + 0.5) * self.dx, self.y0 + (row + 0.5) * self.dy


def grid_cells(spark: SparkSession, g: Grid) -> DataFrame:
    return spark.range(g.n_rows * g.n_cols).select((F.col("id") / g.n_cols).cast("int").alias("row"), (F.col("id") % g.n_cols).cast("int").alias("col"))


# -- projection ---------------------------------------------------------------

A, FLAT = 6378137.0, 1 / 298.257223563
N3 = FLAT / (2 - FLAT)
#: Series of the transverse Mercator projection to the third order of the third flattening.
ALPHA = (N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16, 13 * N3**2 / 48 - 3 * N3**3 / 5, 61 * N3**3 / 240)
BETA = (N3 / 2 - 2 * N3**2 / 3 + 37 * N3**3 / 96, N3**2 / 48 + N3**3 / 15, 17 * N3**3 / 480)
DELTA = (2 * N3 - 2 * N3**2 / 3 - 2 * N3**3, 7 * N3**2 / 3 - 8 * N3**3 / 5, 56 * N3**3 / 15)
RECTIFYING = A / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
SCALE, EAST, SOUTH = 0.9996, 500_000.0, 10_000_000.0


def utm_zone(epsg: int) -> tuple[float, float]:
    """(central meridian, false northing) of EPSG 326xx and 327xx."""
    if epsg // 100 not in (326, 327):
        raise ValueError(f"EPSG {epsg} is not supported")
    return (epsg % 100) * 6 - 183.0, SOUTH if epsg // 100 == 327 else 0.0


def to_utm(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    meridian, north = utm_zone(epsg)
    phi, dl = F.radians(lat), F.radians(lon - meridian)
    k = 2 * math.sqrt(N3) / (1 + N3)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - k * F.atanh(k * s))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EAST + SCALE * RECTIFYING * x, north + SCALE * RECTIFYING * y


def from_utm(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """(lon, lat)."""
    meridian, north = utm_zone(epsg)
    xi0, eta0 = (y - north) / (SCALE * RECTIFYING), (x - EAST) / (SCALE * RECTIFYING)
    xi, eta = xi0, eta0
    for j, b in enumerate(BETA, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return meridian + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else from_utm(x, y, source)
    return (lon, lat) if target == 4326 else to_utm(lon, lat, target)


def number(v: float) -> str:
    """A double in SQL, in brackets: two minus signs would begin a comment."""
    return f"({v!r})" if "e" in repr(v) else f"({v!r}e0)"


def aeqd_steps(lon: str, lat: str, lon0: float, lat0: float, rounds: int = 5) -> list[dict[str, str]]:
    """Columns to add one set after another, in SQL; the last are x and y of to_aeqd()."""
    f, ratio = number(FLAT), number(1 - FLAT)
    u1 = math.atan((1 - FLAT) * math.tan(math.radians(lat0)))
    s1, c1 = number(math.sin(u1)), number(math.cos(u1))
    steps = [{"__u": f"ATAN({ratio}*TAN(RADIANS({lat})))", "__l": f"RADIANS({lon}-{number(lon0)})"}, {"__su": "SIN(__u)", "__cu": "COS(__u)"}]
    now = "__l"
    for i in range(rounds):
        ss, cs, sa, sg, ca, cm, cc, new = (f"__{n}{i}" for n in ("ss", "cs", "sa", "sg", "ca", "cm", "cc", "l"))
        steps += [
            {ss: f"SQRT(POWER(__cu*SIN({now}),2)+POWER({c1}*__su-{s1}*__cu*COS({now}),2))", cs: f"{s1}*__su+{c1}*__cu*COS({now})"},
            {sg: f"ATAN2({ss},{cs})", sa: f"COALESCE({c1}*__cu*SIN({now})/NULLIF({ss},0e0),0e0)"},
            {ca: f"1e0-{sa}*{sa}"},
            {cm: f"COALESCE({cs}-2*{s1}*__su/NULLIF({ca},0e0),0e0)", cc: f"{f}/16*{ca}*(4+{f}*(4-3*{ca}))"},
            {new: f"__l+(1-{cc})*{f}*{sa}*({sg}+{cc}*{ss}*({cm}+{cc}*{cs}*(2*{cm}*{cm}-1)))"},
        ]
        now = new
    steps += [
        {"__q": f"{ca}*{number(1 / (1 - FLAT) ** 2 - 1)}"},
        {"__a": "1+__q/16384*(4096+__q*(-768+__q*(320-175*__q)))", "__b": "__q/1024*(256+__q*(-128+__q*(74-47*__q)))"},
        {"__d": f"__b*{ss}*({cm}+__b/4*({cs}*(2*{cm}*{cm}-1)-__b/6*{cm}*(4*{ss}*{ss}-3)*(4*{cm}*{cm}-3)))"},
        {"__s": f"{number(A * (1 - FLAT))}*__a*({sg}-__d)", "__z": f"ATAN2(__cu*SIN({now}),{c1}*__su-{s1}*__cu*COS({now}))"},
        {"x": "__s*SIN(__z)", "y": "__s*COS(__z)"},
    ]
    return steps


def to_aeqd(df: DataFrame, lon: str, lat: str, lon0: float, lat0: float) -> DataFrame:
    """df with x and y, metres east and north in the azimuthal equidistant projection about (lon0, lat0).

    Length and azimuth of the geodesic by Vincenty's inverse formula in a fixed number of rounds, each of which brings
    it 300 times nearer; not for points near the antipode. A missing coordinate gives missing x and y.
    """
    out = df
    for step in aeqd_steps(lon, lat, lon0, lat0):
        out = out.withColumns({n: F.expr(e) for n, e in step.items()})
    valid = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    return out.select(*df.columns, *(F.when(valid, F.col(c)).alias(c) for c in ("x", "y")))


def from_aeqd_steps(x: str, y: str, lon0: float, lat0: float, rounds: int = 6) -> list[dict[str, str]]:
    """Columns to add one set after another, in SQL; the last are lon and lat of from_aeqd()."""
    f = number(FLAT)
    u1 = math.atan((1 - FLAT) * math.tan(math.radians(lat0)))
    s1, c1 = number(math.sin(u1)), number(math.cos(u1))
    steps = [
        {"__s": f"SQRT({x}*{x}+{y}*{y})"},
        {"__sz": f"COALESCE({x}/NULLIF(__s,0e0),0e0)", "__cz": f"COALESCE({y}/NULLIF(__s,0e0),1e0)"},
        {"__sa": f"{c1}*__sz", "__g1": f"ATAN2({s1},{c1}*__cz)"},
        {"__ca": "1e0-__sa*__sa"},
        {"__q": f"__ca*{number(1 / (1 - FLAT) ** 2 - 1)}"},
        {"__a": "1+__q/16384*(4096+__q*(-768+__q*(320-175*__q)))", "__b": "__q/1024*(256+__q*(-128+__q*(74-47*__q)))"},
        {"__g": f"__s/({number(A * (1 - FLAT))}*__a)"},
    ]
    now = "__g"
    for i in range(rounds):
        m, new = f"__m{i}", f"__n{i}"
        steps += [
            {m: f"COS(2*__g1+{now})"},
            {new: f"__g+__b*SIN({now})*({m}+__b/4*(COS({now})*(2*{m}*{m}-1)-__b/6*{m}*(4*SIN({now})*SIN({now})-3)*(4*{m}*{m}-3)))"},
        ]
        now = new
    across, along = f"({s1}*COS({now})+{c1}*SIN({now})*__cz)", f"({s1}*SIN({now})-{c1}*COS({now})*__cz)"
    steps += [
        {"__m": f"COS(2*__g1+{now})", "__c": f"{f}/16*__ca*(4+{f}*(4-3*__ca))", "__l": f"ATAN2(SIN({now})*__sz,{c1}*COS({now})-{s1}*SIN({now})*__cz)"},
        {"lat": f"DEGREES(ATAN2({across},{number(1 - FLAT)}*SQRT(__sa*__sa+{along}*{along})))", "__d": f"__l-(1-__c)*{f}*__sa*({now}+__c*SIN({now})*(__m+__c*COS({now})*(2*__m*__m-1)))"},
        {"lon": f"{number(lon0)}+DEGREES(__d)"},
    ]
    return steps


def from_aeqd(df: DataFrame, x: str, y: str, lon0: float, lat0: float) -> DataFrame:
    """df with lon and lat of metres east and north in the azimuthal equidistant projection about (lon0, lat0).

    The end of the geodesic by Vincenty's direct formula in a fixed number of rounds. Longitudes run on beyond 180 degrees
    from lon0; a missing coordinate gives missing lon and lat.
    """
    out = df
    for step in from_aeqd_steps(x, y, lon0, lat0):
        out = out.withColumns({n: F.expr(e) for n, e in step.items()})
    valid = F.col(x).isNotNull() & F.col(y).isNotNull()
    return out.select(*df.columns, *(F.when(valid, F.col(c)).alias(c) for c in ("lon", "lat")))


# -- regridding -------------------------------------------------------------------


def mapped(spark: SparkSession, target: Grid, source: Grid, target_epsg: int = 4326, source_epsg: int = 4326) -> DataFrame:
    """Target cells with fr, fc: where their centres lie among source cells."""
    cells = grid_cells(spark, target)
    x, y = target.centre(F.col("row"), F.col("col"))
    fr, fc = source.fraction(*reproject(x, y, target_epsg, source_epsg))
    return cells.withColumns({"fr": fr, "fc": fc})


def cubic_weight(d: Column) -> Column:
    """Cubic B-spline."""
    a = F.abs(d)
    return F.when(a < 1, 2 / 3 - a * a + a * a * a / 2).when(a < 2, F.pow(2 - a, 3) / 6).otherwise(0.0)


def linear_weight(d: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.abs(d))


def regrid(cells: DataFrame, spark: SparkSession, target: Grid, source: Grid, bands: Sequence[str], method: str = "nearest", keys: Sequence[str] = (), target_epsg: int = 4326, source_epsg: int = 4326) -> DataFrame:
    """cells(keys, row, col, bands) on the target grid: nearest, bilinear or cubicspline; missing neighbours are left out and weights renormalised."""
    at = mapped(spark, target, source, target_epsg, source_epsg)
    renamed = cells.select(*keys, F.col("row").alias("srow"), F.col("col").alias("scol"), *bands)
    if method == "nearest":
        at = at.select("row", "col", F.floor(F.col("fr") + 0.5).cast("int").alias("srow"), F.floor(F.col("fc") + 0.5).cast("int").alias("scol"))
        return at.join(renamed, ["srow", "scol"]).select(*keys, "row", "col", *bands)
    reach, weight = {"bilinear": ((0, 1), linear_weight), "cubicspline": ((-1, 2), cubic_weight)}[method]
    near = F.sequence(F.lit(reach[0]), F.lit(reach[1]))
    at = at.withColumn("i", F.explode(near)).withColumn("j", F.explode(near))
    at = at.withColumns({"srow": (F.floor("fr") + F.col("i")).cast("int"), "scol": (F.floor("fc") + F.col("j")).cast("int")})
    at = at.withColumn("w", weight(F.col("fr") - F.col("srow")) * weight(F.col("fc") - F.col("scol"))).filter("w > 0")
    met = at.select("row", "col", "srow", "scol", "w").join(renamed, ["srow", "scol"])
    return met.groupBy(*keys, "row", "col").agg(*(weighted(b).alias(b) for b in bands))


def weighted(band: str) -> Column:
    w = F.when(F.col(band).isNotNull(), F.col("w"))
    return F.sum(w * F.col(band)) / F.nullif(F.sum(w), F.lit(0.0))


def coarse(cells: DataFrame, factor: int | tuple[float, float], keys: Sequence[str], aggregates: dict[str, Column], row: str = "row", col: str = "col") -> DataFrame:
    """Fine cells aggregated into coarse ones of `factor` rows and columns each."""
    fr, fc = factor if isinstance(factor, tuple) else (factor, factor)
    return cells.groupBy(*keys, F.floor(F.col(row) / fr).cast("int").alias(row), F.floor(F.col(col) / fc).cast("int").alias(col)).agg(*(a.alias(n) for n, a in aggregates.items()))


def regrid_average(cells: DataFrame, factor: int, bands: Sequence[str], keys: Sequence[str] = (), **axes: str) -> DataFrame:
    return coarse(cells, factor, keys, {b: F.avg(b) for b in bands}, **axes)


def shares(axis: str, count: int, start: float, step: float, target_start: float, target_step: float) -> Column:
    """Of a source cell's place along an axis the target places that it overlaps, each with the overlap in target cells."""
    ends = [(start + (F.col(axis) + i) * step - target_start) / target_step for i in (0, 1)]
    low, high = F.least(*ends), F.greatest(*ends)
    first, last = F.greatest(F.lit(0), F.floor(low)).cast("int"), F.least(F.lit(count - 1), F.ceil(high) - 1).cast("int")
    places = F.when(first <= last, F.sequence(first, last))
    return F.transform(places, lambda i: F.struct(i.alias("at"), (F.least(high, i + 1.0) - F.greatest(low, i.cast("double"))).alias("w")))


def regrid_area(cells: DataFrame, source: Grid, target: Grid, bands: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Means of the source cells in each target cell, weighted by the area they share; any two grids along the same axes.

    Overlaps along rows and along columns are intervals of indices, so that a source cell knows its target cells. Missing
    values are left out and the weights renormalised; target cells that nothing overlaps are absent.
    """
    rows = F.explode(shares("row", target.n_rows, source.y0, source.dy, target.y0, target.dy)).alias("r")
    cols = F.explode(shares("col", target.n_cols, source.x0, source.dx, target.x0, target.dx)).alias("c")
    at = cells.select(*keys, "row", "col", *bands, rows).select(*keys, *bands, "r", cols)
    at = at.select(*keys, F.col("r.at").alias("row"), F.col("c.at").alias("col"), (F.col("r.w") * F.col("c.w")).alias("w"), *bands).filter("w > 1e-12")
    return at.groupBy(*keys, "row", "col").agg(*(weighted(b).alias(b) for b in bands))


def regrid_max(cells: DataFrame, factor: int, bands: Sequence[str], keys: Sequence[str] = (), **axes: str) -> DataFrame:
    return coarse(cells, factor, keys, {b: F.max(b) for b in bands}, **axes)


def block_majority(cells: DataFrame, band: str, factor: int = 2, keys: Sequence[str] = (), **axes: str) -> DataFrame:
    """The most frequent value, of equal ones the smallest."""
    return coarse(cells, factor, keys, {band: F.mode(band, True)}, **axes)


def regrid_mode(cells: DataFrame, band: str, source: Grid, target: Grid, keys: Sequence[str] = (), source_epsg: int = 4326, target_epsg: int = 4326) -> DataFrame:
    """The most frequent class of the source cells whose centres lie in a target cell, of equal ones the smallest. Missing classes do not count."""
    row, col = target.rowcol(*reproject(*source.centre(F.col("row"), F.col("col")), source_epsg, target_epsg))
    at = cells.filter(F.col(band).isNotNull()).select(*keys, row.alias("row"), col.alias("col"), band)
    return at.filter(F.col("row").between(0, target.n_rows - 1) & F.col("col").between(0, target.n_cols - 1)).groupBy(*keys, "row", "col").agg(F.mode(band, True).alias(band))


def mosaic_first_nonzero(cells: DataFrame, band: str, order: str, keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Of overlapping tiles the first with a value other than 0, else 0."""
    first = F.min_by(F.when(F.col(band) != 0, F.col(band)), F.when(F.col(band) != 0, F.col(order)))
    return cells.groupBy(*keys).agg(F.coalesce(first, F.lit(0)).alias(band))


def aggregate_to_lowres(cells: DataFrame, factor: int | tuple[float, float], bands: Sequence[str], keys: Sequence[str] = (), **axes: str) -> DataFrame:
    """Mean and population deviation of each band."""
    return coarse(cells, factor, keys, {f"{b}_{n}": f(b) for b in bands for n, f in (("mean", F.avg), ("std", F.stddev_pop))}, **axes)


def steady_to_lowres(cells: DataFrame, factor: int | tuple[float, float], bands: Sequence[str], keys: Sequence[str] = (), **axes: str) -> DataFrame:
    """aggregate_to_lowres, to the last bit the same for the same values, in whatever order rows arrive: a coarse cell's values are added in ascending order."""

    def add(s: Column, x: Column) -> Column:
        n, apart = s["n"] + 1, x - s["mean"]
        mean = s["mean"] + apart / n
        return F.struct(n.alias("n"), (s["sum"] + x).alias("sum"), mean.alias("mean"), (s["squares"] + apart * (x - mean)).alias("squares"))

    none = F.struct(F.lit(0).alias("n"), *(F.lit(0.0).alias(f) for f in ("sum", "mean", "squares")))
    end = lambda s: F.when(s["n"] > 0, F.struct((s["sum"] / s["n"]).alias("mean"), F.sqrt(s["squares"] / s["n"]).alias("std")))
    # a coarse cell has no more values than fine cells, so that these fit into a row
    out = coarse(cells, factor, keys, {b: F.aggregate(F.sort_array(F.collect_list(F.col(b).cast("double"))), none, add, end) for b in bands}, **axes)
    return out.select(*(c for c in out.columns if c not in bands), *(F.col(b)[n].alias(f"{b}_{n}") for b in bands for n in ("mean", "std")))


def regrid_in_radiance(cells: DataFrame, factor: int, band: str, maxima: Sequence[str] = (), keys: Sequence[str] = (), **axes: str) -> DataFrame:
    """Temperature averaged as radiance; masks by their maximum."""
    from ..functions.physics import brightness, radiance

    return coarse(cells, factor, keys, {band: brightness(F.avg(radiance(F.col(band))))} | {m: F.max(F.coalesce(F.col(m), F.lit(1))) for m in maxima}, **axes)


def overviews(cells: DataFrame, bands: Sequence[str], levels: Sequence[int] = (4, 8, 16), keys: Sequence[str] = (), row: str = "row", col: str = "col") -> DataFrame:
    """Mean pyramids of all levels in one pass over the cells."""
    at = cells.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    return at.groupBy(*keys, "level", F.floor(F.col(row) / F.col("level")).cast("int").alias(row), F.floor(F.col(col) / F.col("level")).cast("int").alias(col)).agg(*(F.avg(b).alias(b) for b in bands))


def blocks(cells: DataFrame, by: int, bx: int, row: str = "row", col: str = "col") -> DataFrame:
    """cells with block_id, the window of by rows and bx columns they fall in."""
    return cells.withColumn("block_id", F.concat_ws("_", F.floor(F.col(row) / by), F.floor(F.col(col) / bx)))


def clip(cells: DataFrame, rows: tuple[int, int], cols: tuple[int, int], row: str = "row", col: str = "col") -> DataFrame:
    return cells.filter(F.col(row).between(*rows) & F.col(col).between(*cols))


def snap_subset(cells: DataFrame, fine: tuple[int, int, int, int], factor: int, row: str = "row", col: str = "col") -> DataFrame:
    """Coarse cells that cover a fine extent (row0, row1, col0, col1), outward."""
    r0, r1, c0, c1 = fine
    return clip(cells, (r0 // factor, r1 // factor), (c0 // factor, c1 // factor), row, col)


def sample_points(points: DataFrame, cells: DataFrame, g: Grid, values: Sequence[str], x: str = "lon", y: str = "lat", row: str = "row", col: str = "col") -> DataFrame:
    """points with the values of the cell each lies in; outside all cells they are missing."""
    r, c = g.rowcol(F.col(x), F.col(y))
    own = cells.select(F.col(row).alias("__r"), F.col(col).alias("__c"), *values)
    return points.withColumns({"__r": r, "__c": c}).join(own, ["__r", "__c"], "left").drop("__r", "__c")


# -- neighbourhoods ------------------------------------------------------------------


def neighbours(cells: DataFrame, bands: Sequence[str], offsets: Sequence[tuple[int, int]], keys: Sequence[str] = (), row: str = "row", col: str = "col") -> DataFrame:
    """Every cell's neighbours: keys, row, col, dr, dc and their bands. Each cell is sent to those it neighbours."""
    o = F.explode(F.array(*(F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in offsets))).alias("o")
    sent = cells.select(*keys, row, col, *bands, o)
    return sent.select(*keys, (F.col(row) - F.col("o.dr")).alias(row), (F.col(col) - F.col("o.dc")).alias(col), F.col("o.dr").alias("dr"), F.col("o.dc").alias("dc"), *bands)


CROSS = ((-1, 0), (1, 0), (0, -1), (0, 1))
AROUND = tuple((r, c) for r in (-1, 0, 1) for c in (-1, 0, 1))


def fill_edge_missing(cells: DataFrame, band: str, keys: Sequence[str] = (), row: str = "row", col: str = "col") -> DataFrame:
    """Missing cells off the border take the mean of their valid 4-neighbours."""
    near = neighbours(cells, [band], CROSS, keys, row, col).groupBy(*keys, row, col).agg(F.avg(band).alias("__near"), F.count("*").alias("__n"))
    out = cells.join(near, [*keys, row, col], "left")
    return out.withColumn(band, F.coalesce(F.col(band), F.when(F.col("__n") == 4, F.col("__near")))).drop("__near", "__n")


def binomial_smooth(cells: DataFrame, band: str, keys: Sequence[str] = (), row: str = "row", col: str = "col") -> DataFrame:
    """3 by 3 weights 1-2-1 by 1-2-1; missing centres stay missing, missing neighbours are left out. Beyond an edge of its key's grid lies the edge cell again."""
    ends = cells.groupBy(*keys).agg(*(f(c).alias(f"{n}_{a}") for a, c in (("r", row), ("c", col)) for n, f in (("lo", F.min), ("hi", F.max))))
    o = F.explode(F.array(*(F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in AROUND))).alias("o")
    at = (cells.join(ends, list(keys)) if keys else cells.crossJoin(F.broadcast(ends))).select(*keys, row, col, F.col(band).isNotNull().alias("__own"), o, "lo_r", "hi_r", "lo_c", "hi_c")
    at = at.withColumns({"__r": F.least("hi_r", F.greatest("lo_r", F.col(row) + F.col("o.dr"))), "__c": F.least("hi_c", F.greatest("lo_c", F.col(col) + F.col("o.dc")))})
    near = cells.select(*keys, F.col(row).alias("__r"), F.col(col).alias("__c"), F.col(band).alias("__v"))
    w = F.when(F.col("__v").isNotNull(), (2 - F.abs("o.dr")) * (2 - F.abs("o.dc")))
    return at.join(near, [*keys, "__r", "__c"]).groupBy(*keys, row, col).agg(F.when(F.first("__own"), F.sum(w * F.col("__v")) / F.sum(w)).alias(band))


def pad_edges(cells: DataFrame, band: str, n_rows: int, n_cols: int, keys: Sequence[str] = ()) -> DataFrame:
    """A grid of n_rows by n_cols for each key; cells beyond the key's last row or column take the nearest."""
    ends = cells.groupBy(*keys).agg(F.max("row").alias("mr"), F.max("col").alias("mc"))
    full = ends.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(n_cols - 1))))
    full = full.select(*keys, "row", "col", F.least("row", "mr").alias("srow"), F.least("col", "mc").alias("scol"))
    own = cells.select(*keys, F.col("row").alias("srow"), F.col("col").alias("scol"), band)
    return full.join(own, [*keys, "srow", "scol"], "left").select(*keys, "row", "col", band)


def terrain(cells: DataFrame, alt: str = "alt", cell_x: float = 20.0, cell_y: float = 20.0, z_factor: float = 1.0, keys: Sequence[str] = (), row: str = "row", col: str = "col") -> DataFrame:
    """slope (rise over run) and aspect (radians, clockwise from north) by Horn's differences; border cells are missing."""
    good = cells.withColumn(alt, F.when(F.col(alt) >= -10000, F.col(alt)))
    near = neighbours(good, [alt], AROUND, keys, row, col)
    gx = F.sum(F.col("dc") * (2 - F.abs("dr")) * F.col(alt)) / (8 * cell_x)
    gy = F.sum(F.col("dr") * (2 - F.abs("dc")) * F.col(alt)) / (8 * cell_y)
    sums = near.groupBy(*keys, row, col).agg(F.when(F.count(alt) == 9, z_factor * gx).alias("gx"), F.when(F.count(alt) == 9, z_factor * gy).alias("gy"))
    aspect = F.pmod(F.atan2(-F.col("gx"), F.col("gy")), F.lit(2 * math.pi))
    return cells.join(sums, [*keys, row, col]).withColumns({"slope": F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2), "aspect": F.when((F.col("gx") != 0) | (F.col("gy") != 0), aspect)}).drop("gx", "gy")


def worldcover_tiles(bounds: DataFrame, year: int) -> DataFrame:
    """Names of the 3-degree tiles over bounds(minx, miny, maxx, maxy)."""
    version = "v100/2020" if year <= 2020 else "v200/2021"
    steps = lambda a, b: F.explode(F.sequence((F.floor(F.col(a) / 3) * 3).cast("int"), (F.floor(F.col(b) / 3) * 3).cast("int"), F.lit(3)))
    at = bounds.select("*", steps("minx", "maxx").alias("lon")).select("*", steps("miny", "maxy").alias("lat"))
    name = F.format_string("%s%02d%s%03d", F.when(F.col("lat") >= 0, "N").otherwise("S"), F.abs("lat"), F.when(F.col("lon") >= 0, "E").otherwise("W"), F.abs("lon"))
    return at.withColumns({"tile": name, "version": F.lit(version)})


def grid_swath(swath: DataFrame, g: Grid, bands: Sequence[str], radius: float = 210.0, metres: float = 111_320.0, at_once: int = 2_000_000, side: int = 32) -> DataFrame:
    """Per grid cell the bands of the nearest swath pixel within `radius` metres; pixels are dealt to the cells around them.

    Pixels go by blocks of cells to so many tasks that each has about `at_once` pairs of a pixel and a cell.
    """
    mid = math.radians(g.y0 + g.dy * g.n_rows / 2)
    ry, rx = math.ceil(radius / abs(g.dy * metres)), math.ceil(radius / abs(g.dx * metres * math.cos(mid)))
    r, c = g.rowcol(F.col("lon"), F.col("lat"))
    tasks = -(-swath.count() * (2 * ry + 1) * (2 * rx + 1) // at_once)
    placed = swath.withColumns({"r": r, "c": c}).repartition(max(1, tasks), F.floor(F.col("r") / side), F.floor(F.col("c") / side))
    around = placed.withColumn("i", F.explode(F.sequence(F.lit(-ry), F.lit(ry)))).withColumn("j", F.explode(F.sequence(F.lit(-rx), F.lit(rx))))
    around = around.withColumns({"row": F.col("r") + F.col("i"), "col": F.col("c") + F.col("j")}).filter(F.col("row").between(0, g.n_rows - 1) & F.col("col").between(0, g.n_cols - 1))
    x, y = g.centre(F.col("row"), F.col("col"))
    far = F.sqrt(F.pow((F.col("lon") - x) * metres * math.cos(mid), 2) + F.pow((F.col("lat") - y) * metres, 2))
    best = F.min_by(F.struct(*bands), F.struct(F.col("far"), F.col("px_id"))).alias("best")
    return around.withColumn("far", F.round(far, 6)).filter(F.col("far") <= radius).groupBy("row", "col").agg(best, F.min("far").alias("distance")).select("row", "col", "distance", *(F.col(f"best.{b}").alias(b) for b in bands))
