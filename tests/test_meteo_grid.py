"""Meteorology on a fine grid: constant fields stay, heights lower temperatures as in the formula; robust lines of odd tables."""

from pyspark.sql import functions as F

from thermaspark.functions import physics as P
from thermaspark.operators import analysis
from thermaspark.operators.grid import Grid
from thermaspark.plans import pipelines


def test_air_temperature_on_a_grid(spark):
    hour = F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    hourly = spark.range(24).select(hour.alias("valid_time"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("cell_id"), (290.0 + F.col("id")).alias("t2m"), F.lit(283.0).alias("d2m"), F.lit(90000.0).alias("sp"), F.lit(9806.65).alias("z"))
    obs = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 09:30:00' AS acq_time UNION ALL SELECT TIMESTAMP_NTZ'2024-02-05 09:30:00'")
    heights = spark.range(36).select((F.col("id") / 6).cast("int").alias("row"), (F.col("id") % 6).cast("int").alias("col"), (F.col("id") * 10.0).alias("alt"))
    got = pipelines.era5_on_grid(obs, hourly, Grid(25, 0.3, -15, -0.3, 2, 2), heights, Grid(25, 0.1, -15, -0.1, 6, 6)).collect()
    one = spark.range(1).select(P.datum_temperature(F.lit(299.5), F.lit(283.0), F.lit(90000.0), F.lit(9806.65)).alias("t"), P.vapour_pressure(F.lit(283.0)).alias("ea"), P.air_pressure(F.lit(90000.0)).alias("p"))
    want = {r["id"]: r["a"] for r in spark.range(36).crossJoin(one).select("id", P.air_temperature(F.col("t"), F.col("ea"), F.col("p"), F.col("id") * 10.0).alias("a")).collect()}
    assert len(got) == 36
    for r in got:
        assert abs(r["t2m"] - 299.5) < 1e-9 and abs(r["air_temperature"] - want[r["row"] * 6 + r["col"]]) < 1e-6


def test_flux_of_the_day_is_added(spark):
    hour = F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-04 00:00:00").cast("timestamp_ntz"))
    hourly = spark.range(72).select(hour.alias("valid_time"), F.lit(0).alias("cell_id"), F.lit(290.0).alias("t2m"), F.lit(3600.0).alias("ssrd"))
    obs = spark.sql("SELECT 0 AS cell_id, TIMESTAMP_NTZ'2024-01-05 09:30:00' AS acq_time")
    row = pipelines.era5_at(obs, hourly, radiation="ssrd").first()
    assert row["t2m"] == 290.0 and abs(row["ssrd"] - 1.0) < 1e-12


def test_robust_line(spark):
    rows = [(float(x), 2.0 * x + 1) for x in range(60)] + [(float(x), 500.0 - 9 * x) for x in range(40)]
    df = spark.createDataFrame(rows, "validation_lst double, lst_s3hr double")
    got = analysis.robust_line(df, ["validation_lst", "lst_s3hr"], seed=1).first()
    assert abs(got["slope"] - 2) < 0.2 and got["n"] >= 60
    assert not analysis.robust_line(df.limit(0), ["validation_lst"]).collect()
    assert not analysis.robust_line(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "validation_lst double, lst_s3hr double"), ["validation_lst"]).collect()
