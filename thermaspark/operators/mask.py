"""Scene filters, masks and quality flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of the confidence word, from the lowest.
BITS = ("coastline", "ocean", "tidal", "land", "inland_water", "unfilled", "spare6", "spare", "cosmetic", "duplicate", "day", "twilight", "sun_glint", "snow", "summary_cloud", "summary_pointing")


def flag(word: Column, name: str) -> Column:
    """The named bit, 0 or 1; null where the word is missing."""
    if name not in BITS:
        raise ValueError(f"unknown flag {name}")
    return F.getbit(word.cast("int"), F.lit(BITS.index(name))).cast("int")


def flag_layers(df: DataFrame, word: str = "confidence_in") -> DataFrame:
    return df.withColumns({f"bit_{n}": flag(F.col(word), n) for n in BITS})


def filter_daytime(df: DataFrame, max_sza: float = 90.0, sza: str = "sza", acq: str = "acq_id") -> DataFrame:
    """Drops acquisitions whose largest sun zenith exceeds the limit; one without any stays."""
    worst = df.groupBy(acq).agg(F.max(sza).alias("worst"))
    return df.join(worst.filter(F.coalesce(F.col("worst") <= max_sza, F.lit(True))).select(acq), acq, "left_semi")


def cloud_share(df: DataFrame, word: str = "confidence_in", acq: str = "acq_id", time: str = "acq_time") -> DataFrame:
    """Cloudy percentage of each acquisition; a missing word counts as clear."""
    return df.groupBy(acq).agg(F.min(time).alias(time), (100 * F.avg(F.coalesce(flag(F.col(word), "summary_cloud"), F.lit(0)))).alias("cloud_pct"))


def least_cloudy_per_day(df: DataFrame, max_cloud_pct: float = 95.0, acq: str = "acq_id", time: str = "acq_time", keys: Sequence[str] = ()) -> DataFrame:
    """Of each UTC day the acquisition with the fewest clouds, the earliest of equal ones, if within the limit."""
    shares = df.groupBy(*keys, acq).agg(F.min(time).alias(time), (100 * F.avg(F.coalesce(flag(F.col("confidence_in"), "summary_cloud"), F.lit(0)))).alias("cloud_pct"))
    day = Window.partitionBy(*keys, F.to_date(time)).orderBy("cloud_pct", time, acq)
    best = shares.withColumn("nth", F.row_number().over(day)).filter((F.col("nth") == 1) & (F.col("cloud_pct") <= max_cloud_pct))
    return df.join(best.select(*keys, acq), [*keys, acq], "left_semi")


def mask(df: DataFrame, hide: Column, bands: Sequence[str]) -> DataFrame:
    """Bands become null where `hide` is true."""
    missing = [b for b in bands if b not in df.columns]
    if missing:
        raise ValueError(f"no band {missing}")
    return df.withColumns({b: F.when(~F.coalesce(hide, F.lit(False)), F.col(b)) for b in bands})


def mask_clouds(df: DataFrame, bands: Sequence[str] = ("lst",), word: str = "confidence_in") -> DataFrame:
    return mask(df, flag(F.col(word), "summary_cloud") == 1, bands)


def quality_flag(word: Column, uncertainty: Column, max_uncertainty: float = 1.0) -> Column:
    """1 if clear and certain enough; a missing uncertainty counts as 0, a missing word is 0."""
    clear = flag(word, "summary_cloud") == 0
    return F.when(clear & (F.coalesce(uncertainty, F.lit(0.0)) <= max_uncertainty), 1).otherwise(0)


def valid_angles(vza1: Column, vza2: Column, vaa1: Column, vaa2: Column) -> Column:
    """Zeniths up to 180, azimuths up to 360, the first sensor's azimuth not 0, none missing."""
    return F.coalesce((vza1 <= 180) & (vza2 <= 180) & (vaa1 <= 360) & (vaa2 <= 360) & (vaa1 != 0), F.lit(False))


def max_over_time(df: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.max(b).alias(b) for b in bands))


def corrected_orbits(granules: DataFrame, attribute: str = "OrbitCorrectionPerformed") -> DataFrame:
    """Granules but those marked as not corrected."""
    return granules.filter(F.coalesce(F.col(attribute) != "False", F.lit(True)))


def _spread(df: DataFrame, keys: Sequence[str], axis: str, reach: dict[str, int], smallest: bool) -> DataFrame:
    """Running maxima (or minima) of columns along one axis, each with its reach, only at cells that exist: one shuffle by line."""
    line = Window.partitionBy(*(k for k in keys if k != axis)).orderBy(axis)
    return df.withColumns({c: (F.min if smallest else F.max)(c).over(line.rangeBetween(-n, n)) for c, n in reach.items()})


def scl_mask(df: DataFrame, scl: str = "scl", keep: Sequence[int] = (2, 4, 5, 6, 7), bad: Sequence[int] = (3, 8, 9, 10, 11), kernel1: int = 9, kernel2: int = 39, erosion: int = 3, keys: Sequence[str] = ("acq_date", "row_hr", "col_hr")) -> DataFrame:
    """keys and `masked`: dilated scene classes.

    Assumed of the process, of which only parameters are known: one mask holds what is not in `keep`, the other what
    is in `bad`; both are eroded, then dilated with their kernels, and united. Windows run along rows, then columns.
    """
    row, col = keys[-2:]
    out = df.select(*keys, (~F.col(scl).isin(*keep)).cast("int").alias("m1"), F.col(scl).isin(*bad).cast("int").alias("m2"))
    out = out.dropna(subset=list(keys))
    for reach, smallest in (({"m1": erosion // 2, "m2": erosion // 2}, True), ({"m1": kernel1 // 2, "m2": kernel2 // 2}, False)):
        for axis in (row, col):
            out = _spread(out, keys, axis, reach, smallest)
    return out.select(*keys, F.greatest("m1", "m2").alias("masked"))
