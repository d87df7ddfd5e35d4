"""Entry points composed of operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import physics as P
from ..operators import composite, grid, mask, temporal
from ..sources import catalog

# Correction coefficients fitted between the two sensors.
GAIN, OFFSET, DIRECTIONAL = 1.110024074017716, -33.008132822189395, -7.547175199010964


def prepare_s3(s3: DataFrame, max_sza: float | None = 90.0, max_cloud_pct: float | None = 95.0, clouds: bool = True) -> DataFrame:
    """Daytime scenes, the least cloudy of each day, cloudy pixels missing; None or False leaves a step out."""
    out = mask.filter_daytime(s3, max_sza) if max_sza is not None else s3
    out = mask.least_cloudy_per_day(out, max_cloud_pct) if max_cloud_pct is not None else out
    return mask.mask_clouds(out) if clouds else out


def prepare_s2(s2: DataFrame, masked: DataFrame | None = None, keys: tuple[str, ...] = ("row_hr", "col_hr"), scenes: DataFrame | None = None, max_cloud: float = 95.0, grids: tuple[grid.Grid, grid.Grid] | None = None) -> DataFrame:
    """Masked reflectance and NDVI as gap-filled dekad medians.

    scenes(acq_date, cloud_cover): cloudier ones are left out before any pixel is read. grids: the pixels' own grid and
    the one that they are resampled to, by nearest cells.
    """
    bands = ["b04", "b08"]
    if scenes is not None:
        s2 = catalog.filter_scenes(s2, scenes, max_cloud, "acq_date")
    if masked is not None:
        s2 = mask.mask(s2.join(masked, ["acq_date", *keys], "left"), F.col("masked") == 1, bands)
    if grids is not None:
        at = s2.select("acq_date", F.col(keys[0]).alias("row"), F.col(keys[1]).alias("col"), *bands)
        near = grid.regrid(at, s2.sparkSession, grids[1], grids[0], bands, "nearest", ["acq_date"])
        s2 = near.withColumnsRenamed({"row": keys[0], "col": keys[1]})
    s2 = s2.withColumn("ndvi", composite.ndvi(F.col("b08"), F.col("b04")))
    return composite.filled_composite(s2, [*bands, "ndvi"], keys)


def era5_at(obs: DataFrame, hourly: DataFrame, elevation: str | None = None, radiation: str | None = None, time_zone: float = 0.0) -> DataFrame:
    """obs with t2m in its time and, with an elevation column, the air temperature 100 m above it.

    radiation: an accumulated variable, whose mean flux over the local day of the observation is added in W m-2.
    """
    names = ["t2m"] if elevation is None else ["t2m", "d2m", "sp", "z"]
    at = temporal.interp_meteo(obs, hourly, names)
    if radiation is not None:
        flux = temporal.integrated_flux(obs.select("cell_id", "acq_time").distinct(), hourly, radiation, 24, time_zone)
        at = at.join(flux.select("cell_id", "acq_time", radiation), ["cell_id", "acq_time"], "left")
    if elevation is None:
        return at
    ea, p = P.vapour_pressure(F.col("d2m")), P.air_pressure(F.col("sp"))
    at = at.withColumn("t_datum", P.datum_temperature(F.col("t2m"), F.col("d2m"), F.col("sp"), F.col("z")))
    return at.withColumn("air_temperature", P.air_temperature(F.col("t_datum"), ea, p, F.col(elevation)))


def era5_on_grid(obs: DataFrame, hourly: DataFrame, source: grid.Grid, heights: DataFrame, target: grid.Grid) -> DataFrame:
    """acq_time, row, col, t2m, air_temperature on the grid of heights(row, col, alt), for obs(acq_time) and the meteorological cells of `source`, numbered row by row.

    Temperatures at sea level, vapour and air pressure are interpolated in time, brought to the fine grid by cubic
    splines, and raised to 100 m above the ground there.
    """
    cells = grid.grid_cells(obs.sparkSession, source).withColumn("cell_id", F.col("row") * source.n_cols + F.col("col"))
    at = temporal.interp_meteo(obs.select("acq_time").distinct().crossJoin(F.broadcast(cells)), hourly, ["t2m", "d2m", "sp", "z"])
    at = at.withColumns({"t_datum": P.datum_temperature(F.col("t2m"), F.col("d2m"), F.col("sp"), F.col("z")), "ea": P.vapour_pressure(F.col("d2m")), "p": P.air_pressure(F.col("sp"))})
    fine = grid.regrid(at, obs.sparkSession, target, source, ["t2m", "t_datum", "ea", "p"], "cubicspline", ["acq_time"])
    met = fine.join(heights, ["row", "col"])
    return met.select("acq_time", "row", "col", "t2m", P.air_temperature(F.col("t_datum"), F.col("ea"), F.col("p"), F.col("alt")).alias("air_temperature"))


def lst_ta(s3: DataFrame, hourly: DataFrame, cell: Column, gain: float | None = GAIN, offset: float | None = OFFSET, directional: float | None = DIRECTIONAL) -> DataFrame:
    """Good pixels with corrected land surface temperature minus air temperature; cell: the meteorological cell of a pixel."""
    good = prepare_s3(s3).withColumn("quality", mask.quality_flag(F.col("confidence_in"), F.col("lst_uncertainty"))).filter("quality = 1 AND lst is not null")
    good = good.withColumn("lst", P.correct_lst(F.col("lst"), F.col("vza"), gain, offset, directional)).withColumn("cell_id", cell)
    return era5_at(good, hourly).withColumn("lst_ta", F.col("lst") - F.col("t2m"))


def daily_lst_ta(s3: DataFrame, hourly: DataFrame, cell: Column) -> DataFrame:
    return lst_ta(s3, hourly, cell).groupBy(F.to_date("acq_time").alias("day")).agg(F.count("*").alias("n"), F.round(F.avg("lst_ta"), 6).alias("lst_ta"))
