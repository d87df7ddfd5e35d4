"""Deterministic inputs in the shapes of satellite data, derived from the star-schema tables. The SQL runs in Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECIPES: dict[str, tuple[str, str]] = {
    "s3_obs": (
        "events",
        """SELECT event_id AS px_id, CAST(FLOOR(event_id/100) AS BIGINT) AS acq_id,
 CAST(MOD(CAST(FLOOR(event_id/10) AS BIGINT),10) AS INT) AS row_lr, CAST(MOD(event_id,10) AS INT) AS col_lr,
 MIN(ts) OVER (PARTITION BY CAST(FLOOR(event_id/100) AS BIGINT)) AS acq_time,
 290.0e0 + value/20.0e0 AS lst, MOD(event_id*7,150)/100.0e0 AS lst_uncertainty,
 CAST(1032 + CASE WHEN event_type='error' THEN 16384 ELSE 0 END AS INT) AS confidence_in,
 30.0e0 + MOD(CAST(FLOOR(event_id/100) AS BIGINT)*37,70) AS sza, CAST(MOD(event_id*11,360) AS DOUBLE) AS saa,
 CAST(MOD(event_id*13,60) AS DOUBLE) AS vza, CAST(MOD(event_id*29,360) AS DOUBLE) AS vaa FROM events""",
    ),
    "s2_obs": (
        "orders",
        """SELECT CAST(MOD(CAST(FLOOR(o_orderkey/20) AS BIGINT),20) AS INT) AS row_hr, CAST(MOD(o_orderkey,20) AS INT) AS col_hr,
 DATE '2023-10-01' + CAST(FLOOR(o_orderkey/400)*5 AS INT) AS acq_date,
 (500+MOD(o_orderkey*17,2500))/10000.0e0 AS b04, (1500+MOD(o_orderkey*23,3500))/10000.0e0 AS b08, CAST(MOD(o_orderkey*7,12) AS INT) AS scl FROM orders""",
    ),
    "era5_hourly": (
        "events",
        """SELECT DATE_TRUNC('hour', ts) AS valid_time, CAST(MOD(user_id,4) AS INT) AS cell_id,
 ROUND(280.0e0 + SUM(value)/COUNT(*)/10.0e0, 6) AS t2m, ROUND(275.0e0+MIN(value)/10.0e0,6) AS d2m, 90000.0e0+COUNT(*)*100 AS sp, 5000.0e0+MOD(user_id,4)*981 AS z
 FROM events GROUP BY DATE_TRUNC('hour', ts), MOD(user_id,4)""",
    ),
    "matchup": (
        "lineitem",
        """SELECT 280.0e0 + l_quantity*1.1e0 + l_discount*20 AS lst_s3hr, 280.0e0 + l_quantity AS validation_lst,
 CAST(MOD(l_partkey,60) AS DOUBLE) AS s3_vza, CAST(MOD(l_partkey*7,360) AS DOUBLE) AS s3_vaa, CAST(20+MOD(l_suppkey,40) AS DOUBLE) AS s3_sza, CAST(MOD(l_suppkey*3,360) AS DOUBLE) AS s3_saa,
 CAST(MOD(l_orderkey,60) AS DOUBLE) AS validation_vza, CAST(MOD(l_orderkey*11,360) AS DOUBLE) AS validation_vaa, CAST(20+MOD(l_suppkey,40) AS DOUBLE) AS validation_sza, CAST(MOD(l_suppkey*3,360) AS DOUBLE) AS validation_saa,
 CAST(10*(1+MOD(l_partkey,9)) AS INT) AS land_cover,
 CONCAT('2024010', MOD(l_suppkey,7)+1, CASE WHEN MOD(l_suppkey,2)=0 THEN 'T093000' ELSE 'T213000' END) AS s3_time,
 CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS validation_cloudmask FROM lineitem""",
    ),
    "dem": ("part", "SELECT CAST(FLOOR(p_partkey/20) AS INT) AS row_hr, CAST(MOD(p_partkey,20) AS INT) AS col_hr, 100.0e0 + p_size*3 AS alt FROM part"),
    "swath": ("customer", "SELECT c_custkey AS px_id, 25.0e0 + MOD(c_custkey,50)*0.0007e0 AS lon, -15.0e0 - FLOOR(c_custkey/50)*0.0007e0 AS lat, 285.0e0 + c_acctbal/1000.0e0 AS lst FROM customer"),
    "points": ("supplier", "SELECT s_suppkey AS point_id, 25.0e0 + MOD(s_suppkey,10)*0.003e0 AS lon, -15.0e0 - FLOOR(s_suppkey/10)*0.0015e0 AS lat FROM supplier"),
    "catalog": ("events", "SELECT CONCAT('/in/31PDR/LST_SHARPENED_', 20240101+MOD(event_id,28), 'T', 100000+MOD(event_id,60)*100, '_fin.tif') AS path FROM events"),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, sql = RECIPES[name]
    frame = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    out = spark.sql(sql.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: frame})
    return out.withColumn("valid_time", out["valid_time"].cast("timestamp_ntz")) if name == "era5_hourly" else out


def with_fixtures(*names: str) -> str:
    """The head of an oracle that defines the named fixtures."""
    return "WITH " + ",\n".join(f"{n} AS ({RECIPES[n][1]})" for n in names)
