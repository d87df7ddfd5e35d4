"""Samples by hash look at few rows of large groups, and are those of a full sort, groups of equal rows included."""

from pyspark.sql import functions as F

from thermaspark.operators import quantiles as Q


def test_samples_equal_a_sort_and_sort_few_hashes(spark, monkeypatch):
    n = 60_000
    df = spark.range(n).select((F.col("id") % 4).cast("int").alias("g"), F.when(F.col("id") % 4 == 1, F.col("id") % 3).otherwise(F.col("id")).alias("v"), F.when(F.col("id") % 4 == 3, F.col("id") % 50).otherwise(0).alias("w"))
    df = df.unionByName(df.filter("v < 40"))
    sizes = spark.createDataFrame([(0, 700), (1, 20), (2, 100_000), (3, 0)], "g int, k long")
    seen, own = [], Q.select_ranks

    def spy(values, targets, by, few=Q.FEW):
        seen.append(values.groupBy("g").agg(F.sum("c").alias("n")).collect())
        return own(values, targets, by, few)

    monkeypatch.setattr(Q, "select_ranks", spy)
    got = Q.hash_sample(df, sizes, "g", ["v", "w"], 7)
    rows = [(r["g"], r["v"], r["w"]) for r in got.collect()]
    every = df.withColumn("h", F.xxhash64(F.lit(7), "v", "w")).collect()
    for g, k in ((0, 700), (1, 20), (2, 100_000), (3, 0)):
        want = sorted((r["h"], r["v"], r["w"]) for r in every if r["g"] == g)[:k]
        assert sorted(r[1:] for r in rows if r[0] == g) == sorted(w[1:] for w in want)
    assert {r["g"]: r["n"] for r in seen[0]}[0] < 1500
