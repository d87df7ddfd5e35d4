"""Optical composites: dekads, medians, gap filling."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dekad(day: Column) -> Column:
    """The first day of the dekad: 1st, 11th or 21st."""
    d = F.dayofmonth(day)
    return F.date_add(F.trunc(day, "month"), F.when(d <= 10, 0).when(d <= 20, 10).otherwise(20))


def ndvi(nir: Column, red: Column) -> Column:
    return (nir - red) / F.nullif(nir + red, F.lit(0.0))


def dekad_composite(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("row_hr", "col_hr"), day: str = "acq_date") -> DataFrame:
    """Median of each band per pixel and dekad."""
    return df.groupBy(*keys, dekad(F.col(day)).alias("dekad")).agg(*(F.median(b).alias(b) for b in bands))


def dekad_number(day: Column) -> Column:
    """Dekads counted on, 36 a year."""
    return (F.year(day) * 12 + F.month(day) - 1) * 3 + F.when(F.dayofmonth(day) <= 10, 0).when(F.dayofmonth(day) <= 20, 1).otherwise(2)


def dekad_numbered(n: Column) -> Column:
    """The first day of the dekad of this number."""
    months = F.floor(n / 3).cast("int")
    return F.make_date(F.floor(months / 12).cast("int"), months % 12 + 1, (n % 3 * 10 + 1).cast("int"))


def at_every_dekad(medians: DataFrame, bands: Sequence[str], keys: Sequence[str], first: Column, last: Column) -> DataFrame:
    """keys, dekad and bands at every dekad numbered from first to last, gaps between known values filled linearly in days; ends stay missing.

    A row brings along the dekads up to the next one of its pixel. Known values are then carried forward in order of time
    and back in the opposite order: frames that only grow, so that a series costs as much as it has rows.
    """
    mine = Window.partitionBy(*keys)
    order = mine.orderBy(F.col("__n").asc_nulls_last())
    rows = medians.select(*keys, dekad_number(F.col("dekad")).alias("__n"), *bands)
    rows = rows.withColumns({"__alone": F.row_number().over(order) == 1, "__next": F.lead("__n").over(order)})
    start = F.when(F.col("__alone"), F.least("__n", first)).otherwise(F.col("__n"))
    end = F.coalesce(F.col("__next") - 1, F.greatest("__n", last))
    rows = rows.select(*keys, "__n", *bands, F.explode(F.when(start <= end, F.sequence(start, end))).alias("__at"))
    own = lambda b: F.when(F.col("__at") == F.col("__n"), F.col(b)).alias(b)
    full = rows.select(*keys, "__at", dekad_numbered(F.col("__at")).alias("dekad"), *(own(b) for b in bands))
    back = mine.orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    ahead = mine.orderBy(F.col("__at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    known = lambda b: F.when(F.col(b).isNotNull(), F.struct("dekad", F.col(b).alias("v")))
    full = full.withColumns({f"__0{b}": F.last(known(b), True).over(back) for b in bands})
    full = full.withColumns({f"__1{b}": F.last(known(b), True).over(ahead) for b in bands})
    out = {}
    for b in bands:
        t0, t1, v0, v1 = (F.col(f"__{i}{b}.{c}") for c in ("dekad", "v") for i in (0, 1))
        out[b] = F.coalesce(F.col(b), v0 + (v1 - v0) * (F.datediff("dekad", t0) / F.nullif(F.datediff(t1, t0), F.lit(0))))
    inside = full.filter(F.col("__at").between(first, last))
    return inside.select(*keys, "dekad", *(c.alias(b) for b, c in out.items()))


def interpolate_linear(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("row_hr", "col_hr")) -> DataFrame:
    """Every pixel at every dekad between its data's first and last; fills gaps linearly in days, ends stay missing."""
    a, b = df.agg(*(f(dekad_number(F.col("dekad"))) for f in (F.min, F.max))).first()
    return at_every_dekad(df, bands, keys, F.lit(a).cast("int"), F.lit(b).cast("int"))


def filled_composite(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("row_hr", "col_hr"), day: str = "acq_date", ends: tuple[datetime.date, datetime.date] | None = None) -> DataFrame:
    """keys, dekad and bands: dekad medians of every pixel with gaps between dekads filled linearly in days; ends stay missing.

    Pixels are shuffled once. The dekads are those that begin within `ends`, or from the data's first to their last.
    """
    numbers = lambda d: (d.year * 12 + d.month - 1) * 3 + min(2, (d.day - 1) // 10)
    if ends is None:
        a, b = df.agg(*(f(dekad_number(F.col(day))) for f in (F.min, F.max))).first()
    else:
        a, b = numbers(ends[0]) + (ends[0].day not in (1, 11, 21)), numbers(ends[1])
    own = df.select(*keys, dekad(F.col(day)).alias("dekad"), *bands).repartition(*keys)
    medians = own.groupBy(*keys, "dekad").agg(*(F.median(b).alias(b) for b in bands))
    return at_every_dekad(medians, bands, keys, F.lit(a).cast("int"), F.lit(b).cast("int"))
