"""Match-up tables between two sensors on one grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import physics as P

ANGLES = ("vza", "vaa", "sza", "saa")


def build_matchups(s3: DataFrame, val: DataFrame, land_cover: DataFrame, keys: tuple[str, ...] = ("pair_id", "row", "col")) -> DataFrame:
    """One row per pixel at which both sensors have a temperature: both temperatures and angles (azimuths in [0, 360)), land cover, the angle between the views, both times."""
    # each side comes once, as whatever made it would be done again for every further join
    a, b = (df.filter("lst != 0") for df in (s3, val))
    a = a.select(*keys, F.col("lst").alias("lst_s3hr"), *(F.col(c).alias(f"s3_{c}") for c in ANGLES), F.col("acq_time").alias("s3_time"))
    b = b.select(*keys, F.col("lst").alias("validation_lst"), *(F.col(c).alias(f"validation_{c}") for c in ANGLES), F.col("acq_time").alias("validation_time"), F.col("cloudmask").alias("validation_cloudmask"), F.col("land_fraction").alias("validation_land_fraction"))
    both = a.join(b, list(keys)).select(*keys, "lst_s3hr", "validation_lst", *(c for df in (a, b) for c in df.columns if c not in (*keys, "lst_s3hr", "validation_lst")))
    out = both.join(land_cover.select(*keys[1:], "land_cover"), list(keys[1:]), "left")
    out = out.withColumn("sesa", P.sun_sensor_angle(F.col("s3_vza"), F.col("validation_vza"), F.col("s3_vaa"), F.col("validation_vaa")))
    return out.withColumns({c: P.normalize_angle(F.col(c)) for c in ("s3_vaa", "s3_saa", "validation_vaa", "validation_saa")})


def align_azimuth(df: DataFrame, by: str = "pair_id") -> DataFrame:
    """Turns the validation azimuths by 180 degrees where a pair's mean solar azimuths differ by 165 to 195; below 10 they stay, anything else is an error."""
    means = df.groupBy(F.col(by).alias("__by")).agg(F.avg(F.col("s3_saa") - F.col("validation_saa")).alias("__gap"))
    gap = F.abs("__gap")
    turn = F.when(gap < 10, 0.0).when(gap.between(165, 195), 180.0).otherwise(F.raise_error(F.lit("azimuths of a pair do not match")).cast("double"))
    met = df.join(means, df[by].eqNullSafe(means["__by"])).withColumn("__turn", turn)
    return met.withColumns({c: F.col(c) - F.col("__turn") for c in ("validation_saa", "validation_vaa")}).drop("__by", "__gap", "__turn")


def difference(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), a - b)


def basic_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def clean_pairs(df: DataFrame, low: float = 250.0, high: float = 380.0) -> DataFrame:
    inside = lambda c: (F.col(c) > low) & (F.col(c) < high)
    return df.filter(inside("lst_s3hr") & inside("validation_lst"))


def histogram(df: DataFrame, value: Column, low: float = -4.0, high: float = 4.0, bins: int = 1000, limit: float = 100.0) -> DataFrame:
    """bin from 0, count; values beyond the limit or the range are left out, the last bin includes its end."""
    v = df.select(value.alias("v")).filter((F.abs("v") <= limit) & F.col("v").between(low, high))
    return v.groupBy(F.least(F.lit(bins - 1), F.floor((F.col("v") - low) / ((high - low) / bins))).cast("int").alias("bin")).agg(F.count("*").alias("n"))
