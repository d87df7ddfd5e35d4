"""Selection against sorting: groups of one value, heavy values, huge spreads, all rows in one group; stretches narrowed many times."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermaspark.operators import analysis, quantiles


def groups(seed=0):
    r = random.Random(seed)
    out = {"one": [5.0], "same": [2.5] * 400, "two": [1.0, 2.0], "spread": [r.choice([-1, 1]) * 10.0 ** r.randint(-300, 300) for _ in range(900)]}
    out["heavy"] = [0.0] * 700 + [r.gauss(0, 1) for _ in range(500)]
    out["all"] = [r.gauss(290, 8) for _ in range(4000)]
    out["close"] = [1.0 + i * 2.0**-52 for i in range(300)]
    return out


@pytest.mark.parametrize("few", [20_000, 40])
def test_quantiles_equal_sorted_ones(spark, few):
    data = groups()
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("all", None), ("none", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    fractions = (0.0, 0.1, 0.25, 0.5, 0.8, 0.9, 1.0)
    got = {r["g"]: r for r in quantiles.group_quantiles(df, F.col("x"), fractions, ["g"], few).collect()}
    assert got.keys() == data.keys()
    for g, vs in data.items():
        assert got[g]["n"] == len(vs)
        ordered = sorted(vs)
        for f, q in zip(fractions, got[g]["q"], strict=True):
            place = f * (len(vs) - 1)
            a, b = ordered[int(np.floor(place))], ordered[int(np.ceil(place))]
            assert q == a + (b - a) * (place - np.floor(place))


def test_a_whole_table_is_one_group(spark):
    df = spark.range(0, 30_001, 1, 8).select(F.pmod(F.col("id") * 7919, F.lit(30_001)).cast("double").alias("x"))
    row = quantiles.group_quantiles(df, F.col("x"), (0.5, 0.8), few=50).collect()
    assert [tuple(row[0]["q"]), row[0]["n"]] == [(15_000.0, 24_000.0), 30_001]
    assert not quantiles.group_quantiles(df.limit(0), F.col("x"), (0.5,)).collect()


@pytest.mark.parametrize("few", [20_000, 30])
def test_samples_are_the_first_by_hash(spark, few):
    rows = [("big", i) for i in range(900)] + [("small", i) for i in range(5)] + [("copies", 7)] * 300 + [("none", 1)] * 4
    df = spark.createDataFrame(rows, "s string, i int").repartition(5)
    sizes = spark.createDataFrame([("big", 100), ("small", 9), ("copies", 30), ("none", 0)], "s string, k long")
    got = quantiles.hash_sample(df, sizes, "s", ["s", "i"], 3, few).collect()
    assert collections.Counter(r["s"] for r in got) == {"big": 100, "small": 5, "copies": 30}
    ranked = [r["i"] for r in df.filter("s = 'big'").withColumn("h", F.xxhash64(F.lit(3), "s", "i")).orderBy("h").limit(100).collect()]
    assert {r["i"] for r in got if r["s"] == "big"} == set(ranked)


def test_no_task_sorts_a_group(spark):
    """Trimming sorts no rows of a group: its windows run over counted values of few kinds, no percentile gathers its values."""
    m = spark.createDataFrame([("t", float(i % 977), 280.0, 1.0, 2.0) for i in range(5000)], "s3_time string, lst_s3hr double, validation_lst double, s3_vza double, validation_vza double")
    kept = analysis.trim_quantiles(m, F.col("lst_s3hr") - F.col("validation_lst"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan
    assert kept.agg(F.min("lst_s3hr"), F.max("lst_s3hr")).first() is not None
