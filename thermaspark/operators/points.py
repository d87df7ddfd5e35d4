"""Point time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import series
from .grid import Grid, sample_points


def polygon_centroids(polygons: DataFrame, ident: str = "poly_id", vertices: str = "vertices") -> DataFrame:
    """ident, x, y of polygons (vertices array<struct<x,y>>, open or closed) that hold their centroid."""
    v = F.col(vertices)
    ring = F.zip_with(v, F.concat(F.slice(v, F.lit(2), F.size(v)), F.slice(v, 1, 1)), lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))
    total = lambda f: F.aggregate("ring", F.lit(0.0), lambda s, e: s + f(e))
    cross = lambda e: e["x0"] * e["y1"] - e["x1"] * e["y0"]
    df = polygons.select(ident, vertices, ring.alias("ring"))
    df = df.withColumn("a", total(cross) / 2).filter("a != 0")
    df = df.withColumns({"x": total(lambda e: (e["x0"] + e["x1"]) * cross(e)) / (6 * F.col("a")), "y": total(lambda e: (e["y0"] + e["y1"]) * cross(e)) / (6 * F.col("a"))})
    crossed = lambda e: F.when(((e["y0"] > F.col("y")) != (e["y1"] > F.col("y"))) & (F.col("x") < (e["x1"] - e["x0"]) * (F.col("y") - e["y0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0)) + e["x0"]), 1).otherwise(0)
    inside = F.aggregate("ring", F.lit(0), lambda s, e: s + crossed(e)) % 2 == 1
    return df.filter(inside).select(ident, "x", "y")


def point_series(stacks: dict[str, DataFrame], points: DataFrame, g: Grid, start: str, end: str, time: str = "day", row: str = "row", col: str = "col") -> DataFrame:
    """series, point_id, day, value for every stack (cells with `value`) between two days, both in."""
    out = None
    for name, cells in stacks.items():
        some = cells.filter(F.col(time).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        got = sample_points(points, some, g, [time, "value"], row=row, col=col).filter(F.col(time).isNotNull()).select(F.lit(name).alias("series"), "point_id", F.col(time).alias("day"), "value")
        out = got if out is None else out.unionByName(got)
    return out


def paired_series(long: DataFrame, first: str, second: str) -> DataFrame:
    """The n-th value of one series beside the n-th of the other, per point, in order of days."""
    a, b = (series(long.filter(F.col("series") == s), ["point_id"], "day").select("point_id", "nth", F.col("day").alias(f"{s}_day"), F.col("value").alias(s)) for s in (first, second))
    return a.join(b, ["point_id", "nth"])
