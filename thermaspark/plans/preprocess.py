"""Preprocessing as one call: terrain, optical bands, coarse and fine thermal products, made unit by unit and resumed.

Stages follow each other through the ledger. A stage reads what the ones before finished and makes the units that are
missing: the tile's terrain once, optical bands by date, thermal products by acquisition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import physics as P
from ..operators import grid, mask
from ..sources import ledger
from . import products

# How products are stored.
STORED = {
    "thermal": {"lst": "S3-LST", "quality_flag": "S3-mask"},
    "angles": {"inc": "S3-inc", "vza": "S3-vzaHR"},
    "terrain": {"alt": "DEM-alt-20m"},
}
STAGES = ("terrain", "optical", "thermal", "angles")


@dataclass(frozen=True)
class Tile:
    """Where inputs lie and products go. Coarse and fine grids share a projection."""

    extent: tuple[float, float, float, float]
    s3: grid.Grid
    s3_epsg: int
    dem: grid.Grid
    coarse: grid.Grid
    fine: grid.Grid
    epsg: int


def preprocess(root: str, s3: DataFrame, s2: DataFrame, heights: DataFrame, tile: Tile, at_once: int = 256, keep_all: bool = False) -> dict[str, int]:
    """How many units each stage made now; read() has the products.

    s3(acq_id, acq_time, row, col, lst, lst_uncertainty, confidence_in, vza) lies on tile.s3, heights(row, col, alt) on
    tile.dem, s2(acq_date, row, col, bands) already on tile.fine. Angles are resampled by cubic splines, the rest of the
    thermal bands by nearest cells; bands that later steps don't read are left out unless keep_all is set.
    """
    spark = s3.sparkSession
    box = [F.lit(float(v)).alias(c) for c, v in zip(ledger.EXTENT, tile.extent, strict=True)]
    unit = lambda df, c: df.select(F.col(c).cast("string").alias("unit")).distinct().select("unit", *box)
    of = lambda df, c, units: df.withColumn("unit", F.col(c).cast("string")).join(units.select("unit"), "unit", "left_semi").drop("unit")
    kept = lambda df, kind, keys: df if keep_all else products.keep_required_bands(df, kind, keys)

    def terrain(units: DataFrame) -> DataFrame:
        near = grid.regrid(heights, spark, tile.fine, tile.dem, ["alt"], target_epsg=tile.epsg, source_epsg=tile.epsg)
        # slopes are those of the fine grid, in its metres
        shape = grid.terrain(near, cell_x=abs(tile.fine.dx), cell_y=abs(tile.fine.dy)).select("row", "col", "slope", "aspect")
        return B.encode(near.join(shape, ["row", "col"]), STORED["terrain"])

    def optical(units: DataFrame) -> DataFrame:
        return kept(of(s2, "acq_date", units), "s2", ["acq_date", "row", "col"])

    def thermal(units: DataFrame) -> DataFrame:
        own = ["acq_id", "acq_time"]
        bands = ["lst", "lst_uncertainty", "confidence_in", "vza"]
        near = grid.regrid(of(s3, "acq_id", units), spark, tile.coarse, tile.s3, bands, "nearest", own, tile.epsg, tile.s3_epsg)
        flagged = near.withColumn("quality_flag", mask.quality_flag(F.col("confidence_in"), F.col("lst_uncertainty")))
        out = kept(flagged, "s3", [*own, "row", "col"])
        return B.encode(out if keep_all else out.drop("vza"), STORED["thermal"])

    def angles(units: DataFrame) -> DataFrame:
        own = ["acq_id", "acq_time"]
        fine = grid.regrid(of(s3, "acq_id", units), spark, tile.fine, tile.s3, ["vza"], "cubicspline", own, tile.epsg, tile.s3_epsg)
        shape = ledger.finished(spark, root, "terrain").select("row", "col", "slope", "aspect")
        lon, lat = grid.reproject(*tile.fine.centre(F.col("row"), F.col("col")), tile.epsg, 4326)
        flat = F.coalesce("aspect", F.lit(0.0))
        inc = P.cos_incidence(lat, lon, F.dayofyear("acq_time"), P.decimal_hour(F.col("acq_time")), flat, P.slope_angle(F.coalesce("slope", F.lit(0.0))))
        return B.encode(fine.join(shape, ["row", "col"]).select(*own, "row", "col", inc.alias("inc"), "vza"), STORED["angles"])

    made = {"terrain": ledger.run_stage(spark.range(1).select(F.lit("tile").alias("unit"), *box), root, "terrain", terrain)}
    made["optical"] = ledger.run_stage(unit(s2, "acq_date"), root, "optical", optical, at_once=at_once)
    made["thermal"] = ledger.run_stage(unit(s3, "acq_id"), root, "thermal", thermal, at_once=at_once)
    made["angles"] = ledger.run_stage(unit(s3, "acq_id"), root, "angles", angles, at_once=at_once)
    return made


def read(spark: SparkSession, root: str, stage: str, decoded: bool = True) -> DataFrame:
    """A stage's finished products, stored values turned into physical ones."""
    out = ledger.finished(spark, root, stage)
    return B.decode(out, {c: b for c, b in STORED.get(stage, {}).items() if c in out.columns}) if decoded else out
