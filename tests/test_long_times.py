"""Long series in time: no frame that is read anew for every row, and results of a plain search."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from thermaspark.operators import temporal as E
from thermaspark.plans import catalogue

from .conftest import DATA


def frames(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().lower().replace(" ", "")


@pytest.mark.parametrize("name", ["d3_interpolate_linear", "d2_d3_filled_composite", "k2_prepare_s2", "k7_ndvi_cells", "k7_ndvi_product", "e1_nearest_date", "e2_bracket", "e3_interp_meteo", "k5_era5_at", "k5_daily_flux", "minimum_slice"])
def test_no_frame_is_read_anew_for_every_row(spark, name):
    assert "currentrow$(),unboundedfollowing" not in frames(catalogue.QUERIES[name](spark, DATA))


def test_nearest_and_bracket_of_long_series(spark):
    hour = F.timestamp_add("MINUTE", (F.col("id") * 7).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    marks = spark.range(30_000).filter("id % 5 != 2").select(F.lit(0).alias("k"), hour.alias("s"))
    obs = spark.range(30_000).select(F.lit(0).alias("k"), hour.alias("t"))
    begun = time.time()
    got = E.bracket(obs, marks, "t", "s", ["k"])
    bad = F.col("before") > F.col("t"), F.col("after") < F.col("t"), F.timestamp_diff("MINUTE", "before", "after") > 14
    assert got.count() == 30_000 and got.filter(bad[0] | bad[1] | bad[2]).count() == 0
    days = lambda k, n: spark.range(n).select(F.date_add(F.lit("1800-01-01").cast("date"), (F.col("id") * k).cast("int")).alias("d"))
    near = {r["d"]: r["nearest"] for r in E.nearest_date(days(3, 30_000), days(5, 18_000).withColumnRenamed("d", "e"), "d", "e").collect()}
    assert time.time() - begun < 40
    origin = datetime.date(1800, 1, 1)
    assert len(near) == 30_000
    for i in range(30_000):
        low = 3 * i // 5 * 5
        want = min((c for c in (low, low + 5) if c <= 5 * 17_999), key=lambda c: (abs(c - 3 * i), c))
        assert near[origin + datetime.timedelta(3 * i)] == origin + datetime.timedelta(want)
