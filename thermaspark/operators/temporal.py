"""Joins in time: nearest, bracketing, interpolation, intervals. None is a nested loop over both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_date(left: DataFrame, right: DataFrame, left_day: str, right_day: str, keys: Sequence[str] = ()) -> DataFrame:
    """left's distinct days with `nearest`, the closest day of right; the earlier of two as close.

    Both lists of days are merged and read once in order: the last day of right so far and the next one to come.
    """
    a = left.select(*keys, F.col(left_day).cast("date").alias("__d")).distinct().withColumn("__own", F.lit(True))
    b = right.select(*keys, F.col(right_day).cast("date").alias("__d")).distinct().withColumn("__own", F.lit(False))
    theirs = F.when(~F.col("__own"), F.col("__d"))
    upto = lambda *order: F.last(theirs, True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    # a frame that ends at the last row is read anew for every row: the days to come are read backwards
    before, after = upto("__d", "__own"), upto(F.desc("__d"), F.desc("__own"))
    both = a.unionByName(b).withColumns({"before": before, "after": after}).filter("__own")
    early = F.col("after").isNull() | (F.datediff("__d", "before") <= F.datediff("after", "__d"))
    return both.select(*keys, F.col("__d").alias(left_day), F.when(F.col("before").isNotNull() & early, F.col("before")).otherwise(F.col("after")).alias("nearest"))


def bracket(obs: DataFrame, series: DataFrame, time: str, series_time: str, keys: Sequence[str]) -> DataFrame:
    """obs with `before`, `after` and `frac` = (after - t) / (after - before); frac 1 where a time is hit. Rows outside the series go."""
    marks = series.select(*keys, F.col(series_time).alias("__t")).distinct()
    own = obs.select(*keys, F.col(time).alias("__t")).distinct()
    merged = marks.withColumn("__m", F.col("__t")).unionByName(own.withColumn("__m", F.lit(None).cast(series.schema[series_time].dataType)))
    upto = lambda f, order: f("__m").over(Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
    # a frame that ends at the last row is read anew for every row: times to come are read backwards
    at = merged.withColumns({"before": upto(F.max, F.asc("__t")), "after": upto(F.min, F.desc("__t"))})
    at = at.filter("__m is null AND before is not null AND after is not null").select(*keys, F.col("__t").alias(time), "before", "after").distinct()
    span = seconds(F.col("before"), F.col("after"))
    return obs.join(at, [*keys, time]).withColumn("frac", F.when(span == 0, 1.0).otherwise(seconds(F.col(time), F.col("after")) / span))


def seconds(a: Column, b: Column) -> Column:
    """From a to b, with microseconds."""
    return F.timestamp_diff("MICROSECOND", a, b) / 1e6


def interp_meteo(obs: DataFrame, hourly: DataFrame, variables: Sequence[str], time: str = "acq_time", series_time: str = "valid_time", keys: Sequence[str] = ("cell_id",)) -> DataFrame:
    """obs with variables interpolated in time; observations outside the series go."""
    at = bracket(obs, hourly, time, series_time, keys)
    for side in ("before", "after"):
        at = at.join(hourly.select(*keys, F.col(series_time).alias(side), *(F.col(v).alias(f"__{side}_{v}") for v in variables)), [*keys, side])
    mixed = {v: F.col(f"__before_{v}") * F.col("frac") + F.col(f"__after_{v}") * (1 - F.col("frac")) for v in variables}
    return at.withColumns(mixed).select(*obs.columns, *variables)


def integrated_flux(obs: DataFrame, hourly: DataFrame, variable: str, window_hours: int = 24, time_zone: float = 0.0, time: str = "acq_time", series_time: str = "valid_time", keys: Sequence[str] = ("cell_id",)) -> DataFrame:
    """keys, time and the mean over the window from local midnight of the observation's local day: hourly increments after its start up to its end; missing hours are 0.

    Hours are dealt to the local days whose window holds them, so the join is by key and day.
    """
    shift = F.expr(f"make_dt_interval(0, 0, 0, {float(time_zone) * 3600})")
    own = obs.select(*keys, time).distinct().withColumn("__day", F.to_date(F.col(time) + shift))
    local = hourly.select(*keys, (F.col(series_time) + shift).alias("__t"), F.col(variable).alias("__v"))
    # an hour at midnight belongs to the day that ends
    hours = local.withColumn("__h", F.floor(seconds(F.to_date("__t").cast("timestamp_ntz"), F.col("__t")) / 3600))
    days = -(-window_hours // 24)
    hours = hours.select(*keys, "__v", "__t", F.explode(F.sequence(F.lit(0), F.lit(days))).alias("__back")).withColumn("__day", F.date_sub(F.to_date("__t"), F.col("__back")))
    passed = seconds(F.col("__day").cast("timestamp_ntz"), F.col("__t")) / 3600
    sums = hours.filter((passed > 0) & (passed <= window_hours)).groupBy(*keys, "__day").agg(F.sum(F.coalesce("__v", F.lit(0.0))).alias("__s"))
    mean = F.coalesce("__s", F.lit(0.0)) / (window_hours * 3600)
    return own.join(sums, [*keys, "__day"], "left").select(*keys, time, mean.alias(variable))


def simultaneous(left: DataFrame, right: DataFrame, minutes: int = 10, inclusive: bool = False, left_time: str = "time", right_time: str = "time", keys: Sequence[str] = ()) -> DataFrame:
    """Pairs less than (or at most) so many minutes apart. Times meet in buckets of that length: left's go to three, right's stay in their own.

    Times are turned into numbers before they meet: what is done for a pair is one subtraction. A merge join reads left once
    and holds right's rows of one bucket.
    """
    size = minutes * 60_000_000
    micros = lambda c: F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    a = left.withColumn("__l", micros(F.col(left_time)))
    a = a.withColumn("__b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda o: F.floor(F.col("__l") / size) + o)))
    b = right.withColumn("__r", micros(F.col(right_time))).withColumn("__b", F.floor(F.col("__r") / size))
    apart = F.abs(F.col("__l") - F.col("__r"))
    near = apart <= size if inclusive else apart < size
    return a.join(b, [*keys, "__b"]).filter(near).drop("__b", "__l", "__r")


def match_granules(granules: DataFrame, name: str = "name", keys: Sequence[str] = ()) -> DataFrame:
    """Granules of the three kinds that share the 25 characters of time and orbit in their names, and `keys`; names without them match nothing."""
    tagged = granules.withColumn("kind", F.regexp_extract(name, "(LSTE|GEO|CLOUD)", 1)).withColumn("key", F.regexp_extract(name, r"(\d{5}_\d{3}_\d{8}T\d{6})", 1)).filter("key != ''")
    parts = [tagged.filter(F.col("kind") == k).select(*keys, "key", F.col(name).alias(k.lower())) for k in ("LSTE", "GEO", "CLOUD")]
    return parts[0].join(parts[1], [*keys, "key"]).join(parts[2], [*keys, "key"]).withColumn("acq_time", F.to_timestamp_ntz(F.substring("key", -15, 15), F.lit("yyyyMMdd'T'HHmmss")))


def align_grids(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Pairs of pixels on one grid that are both non-zero: keys, left_value, right_value."""
    a, b = (d.filter(F.col(value) != 0).select(*keys, F.col(value).alias(f"{n}_{value}")) for d, n in ((left, "left"), (right, "right")))
    return a.join(b, list(keys))
