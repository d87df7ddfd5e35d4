"""Series of many dates, as years of scenes give: results of a plain loop."""

import datetime
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermaspark.operators import composite as D


@pytest.mark.parametrize("fill", ["filled_composite", "interpolate_linear"])
def test_a_pixel_of_six_centuries(spark, fill):
    n = 22_000
    day = F.date_add(F.lit("1700-01-01").cast("date"), (F.col("id") * 10).cast("int"))
    df = spark.range(n).select(F.lit(0).alias("row_hr"), F.lit(0).alias("col_hr"), day.alias("acq_date"), F.when(F.col("id") % 7 < 3, F.col("id") * 37 % 101.0).alias("a"))
    begun = time.time()
    out = D.filled_composite(df, ["a"]) if fill == "filled_composite" else D.interpolate_linear(D.dekad_composite(df, ["a"]), ["a"])
    got = {r["dekad"]: r["a"] for r in out.collect()}
    assert time.time() - begun < 40
    known: dict[datetime.date, list[float]] = {}
    first = datetime.date(1700, 1, 1)
    for i in range(n):
        d = first + datetime.timedelta(10 * i)
        known.setdefault(d.replace(day=1 if d.day <= 10 else 11 if d.day <= 20 else 21), []).extend([float(i * 37 % 101)] if i % 7 < 3 else [])
    last = max(known)
    known = {d: float(np.median(v)) for d, v in known.items() if v}
    ends = sorted(known)
    axis = [d for k in range((last - first).days + 1) if (d := first + datetime.timedelta(k)).day in (1, 11, 21)]
    want = np.interp([d.toordinal() for d in axis], [d.toordinal() for d in ends], [known[d] for d in ends])
    assert sorted(got) == axis
    for d, v in zip(axis, want, strict=True):
        assert got[d] is None if not ends[0] <= d <= ends[-1] else abs(got[d] - v) < 1e-9


def test_pixels_without_dates_are_kept(spark):
    rows = [(0, None, 5.0), (1, None, 1.0), (1, datetime.date(2024, 1, 11), 2.0), (1, datetime.date(2024, 2, 1), None), (1, datetime.date(2024, 2, 11), 5.0), (2, datetime.date(2024, 1, 1), 9.0)]
    df = spark.createDataFrame(rows, "p int, acq_date date, a double")
    got = {(r["p"], r["dekad"].month, r["dekad"].day): r["a"] for r in D.filled_composite(df, ["a"], ["p"]).collect()}
    axis = [(1, 1), (1, 11), (1, 21), (2, 1), (2, 11)]
    assert set(got) == {(p, *d) for p in (0, 1, 2) for d in axis}
    assert [got[0, *d] for d in axis] == [None] * 5 and [got[2, *d] for d in axis] == [9.0] + [None] * 4
    assert got[1, 1, 1] is None and got[1, 1, 11] == 2.0 and got[1, 2, 11] == 5.0 and abs(got[1, 1, 21] - (2 + 3 * 10 / 31)) < 1e-12
