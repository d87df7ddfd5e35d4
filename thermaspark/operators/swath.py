"""Irregular pixels of a swath on a grid: the nearest in the plane, by buckets that widen until the radius is covered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .grid import Grid, grid_cells, to_aeqd

AROUND = tuple((i, j) for i in (-1, 0, 1) for j in (-1, 0, 1))


def nearest(cells: DataFrame, pixels: DataFrame, keys: Sequence[str], bands: Sequence[str], radius: float, first: float) -> DataFrame:
    """keys, row, col, distance and bands of the nearest pixel within `radius` metres; of equally near ones the smallest px_id.

    cells(keys, row, col, x, y) look into the nine buckets around them, of `first` metres at the start. Whatever lies
    within a bucket's size is in these, so that a cell whose nearest pixel is no farther has it; the others look again
    with buckets twice as large, until none is left. Both sides are shuffled: written tables are small on disk, and Spark
    would take them for tables that the driver can hold.
    """
    at, size, found, left = [*keys, "row", "col"], first, [], cells.select(*keys, "row", "col", "x", "y")
    offsets = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in AROUND))).alias("o")
    while True:
        bucket = lambda c, size=size: F.floor(F.col(c) / size)
        around = left.select(*at, F.col("x").alias("cx"), F.col("y").alias("cy"), offsets, bucket("x").alias("bx"), bucket("y").alias("by"))
        around = around.select(*at, "cx", "cy", (F.col("bx") + F.col("o.i")).alias("bx"), (F.col("by") + F.col("o.j")).alias("by"))
        near = pixels.select(*keys, "px_id", "x", "y", *bands, bucket("x").alias("bx"), bucket("y").alias("by"))
        far = F.round(F.sqrt(F.pow(F.col("x") - F.col("cx"), 2) + F.pow(F.col("y") - F.col("cy"), 2)), 6)
        met = around.join(near.hint("merge"), [*keys, "bx", "by"]).withColumn("distance", far)
        best = met.groupBy(*at).agg(F.min(F.struct("distance", "px_id")).alias("near"), F.min_by(F.struct(*bands), F.struct("distance", "px_id")).alias("own"))
        best = best.select(*at, F.col("near.distance").alias("distance"), *(F.col(f"own.{b}").alias(b) for b in bands))
        last = size >= radius
        sure = best.filter(F.col("distance") <= (radius if last else size))
        if last:
            found.append(sure)
            break
        sure = staged(sure, "nearest")
        found.append(sure)
        left = staged(left.join(sure.select(*at).hint("merge"), at, "left_anti"), "open")
        if left.isEmpty():
            break
        size *= 2
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def grid_swath_plane(swath: DataFrame, g: Grid, bands: Sequence[str], keys: Sequence[str] = (), radius: float = 210.0, first: float | None = None) -> DataFrame:
    """keys, row, col, distance, bands: swaths (keys, px_id, lon, lat, bands) on a grid of degrees, nearest in the azimuthal equidistant plane about the grid's middle."""
    keys_of = list(keys) or ["__all"]
    own = swath if keys else swath.withColumn("__all", F.lit(0))
    lon0, lat0 = g.x0 + g.dx * g.n_cols / 2, g.y0 + g.dy * g.n_rows / 2
    # a range: as sequences all rows would be literals of the plan
    lon, lat = g.centre(F.col("row"), F.col("col"))
    # written, or joins would push their conditions through every step of the projection; projected once for all keys
    places = staged(to_aeqd(grid_cells(own.sparkSession, g).withColumns({"lon": lon, "lat": lat}), "lon", "lat", lon0, lat0), "places")
    cells = places.crossJoin(F.broadcast(own.select(*keys_of).distinct()))
    # dealt out first: a small file would be one task, and the projection is most of the work
    placed = own.filter("lon IS NOT NULL AND lat IS NOT NULL").select(*keys_of, "px_id", "lon", "lat", *bands).repartition(*keys_of, "px_id")
    pixels = staged(to_aeqd(placed, "lon", "lat", lon0, lat0), "pixels")
    step = first or abs(g.dy) * 111_320.0
    out = nearest(cells, pixels, keys_of, bands, radius, step)
    return out if keys else out.drop("__all")
