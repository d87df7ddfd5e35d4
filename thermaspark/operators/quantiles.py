"""Exact order statistics and samples of groups of any size, without a group in one task.

Selection narrows every wanted rank to a stretch of values: sketches, which combine before the shuffle, propose two
values close to the rank, counts of the rows below and between them say whether they hold it, and only what lies between
goes into the next round. Rows between are counted by value, so that equal values are one row. When a stretch has few
different values, a running sum over these finds the rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import drop_staged, staged

#: Different values of a stretch that are sorted at once, and the accuracy of the sketches (a rank within n / ACCURACY).
FEW, ACCURACY = 20_000, 1000


def select_ranks(values: DataFrame, targets: DataFrame, by: Sequence[str], few: int = FEW, accuracy: int = ACCURACY) -> DataFrame:
    """by, slot, rank, value: the value at each rank, from 0, of its group's values in ascending order.

    values: by, v and, where a row stands for several, their number c; nulls are left out. targets: by, slot, rank, slots
    being different in a group. Ranks beyond the group have no row.
    """
    rows = values.filter("v IS NOT NULL").groupBy(*by, "v").agg((F.sum("c") if "c" in values.columns else F.count("*")).alias("c"))
    slots = targets.select(*by, "slot", F.col("rank").alias("wanted"), F.col("rank").alias("rank"))
    found = []
    # every slot has its stretch of values; in the beginning the whole group, which slots of a group share
    live = staged(rows.select(*by, F.lit(-1).cast("int").alias("slot"), "v", "c"), "values")
    slots = staged(slots.withColumn("own", F.lit(-1).cast("int")), "slots")
    while True:
        own = [*by, "own"]
        stretch = live.withColumnRenamed("slot", "own")
        sizes = stretch.groupBy(*own).agg(F.sum("c").alias("n"), F.count("*").alias("kinds"), F.min("v").alias("least"))
        at = slots.join(sizes, own).filter("rank < n")
        # few different values: sorted; the others are narrowed
        small = stretch.join(sizes.filter(F.col("kinds") <= few).select(*own), own, "left_semi")
        order = Window.partitionBy(*own).orderBy("v")
        summed = small.select(*own, "v", F.sum("c").over(order).alias("upto"), "c")
        hit = at.filter(F.col("kinds") <= few).select(*own, "slot", "wanted", "rank").join(summed, own).filter("upto - c <= rank AND rank < upto")
        found.append(staged(hit.select(*by, "slot", F.col("wanted").alias("rank"), F.col("v").alias("value")), "ranks"))
        big = at.filter(F.col("kinds") > few)
        if not big.take(1):
            break
        big = staged(big.select(*own, "slot", "wanted", "rank", "n", "kinds", "least"), "big")
        # a sketch of kinds, each once, halves them at least; one of rows would stop at heavy values
        near = stretch.join(big.select(*own).distinct(), own, "left_semi").groupBy(*own).agg(F.percentile_approx("v", [i / 64 for i in range(65)], accuracy).alias("cuts"))
        edges = near.select(*own, F.posexplode(F.array_distinct("cuts")).alias("k", "low"))
        following = Window.partitionBy(*own).orderBy("k")
        bins = staged(edges.select(*own, "k", "low", F.lead("low").over(following).alias("high")), "bins")
        placed = stretch.join(near, own).withColumn("k", F.size(F.filter(F.array_distinct("cuts"), lambda x: x <= F.col("v"))) - 1)
        counts = placed.groupBy(*own, "k").agg(F.sum("c").alias("in_bin"))
        below = counts.withColumn("upto", F.sum("in_bin").over(following))
        chosen = big.join(below, own).filter("upto - in_bin <= rank AND rank < upto")
        chosen = staged(chosen.select(*by, "own", "slot", "wanted", (F.col("rank") - (F.col("upto") - F.col("in_bin"))).alias("rank"), "k"), "chosen")
        narrowed = placed.join(chosen.select(*own, "k", "slot"), [*own, "k"]).select(*by, "slot", "v", "c")
        after = staged(narrowed, "values")
        for old in (live, slots, big, bins):
            drop_staged(old)
        live, slots = after, staged(chosen.select(*by, "slot", "wanted", "rank").withColumn("own", F.col("slot")), "slots")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def group_quantiles(df: DataFrame, value: Column, fractions: Sequence[float], by: Sequence[str] = (), few: int = FEW) -> DataFrame:
    """by, n (values that aren't null) and q, an array of the quantiles, linear between ranks. No group has to fit into a task."""
    keys = list(by) or ["__all"]
    named = df.select(*by, value.cast("double").alias("v")) if by else df.select(F.lit(0).alias("__all"), value.cast("double").alias("v"))
    named = named.filter("v IS NOT NULL")
    sizes = staged(named.groupBy(*keys).agg(F.count("*").alias("n")), "sizes")
    places = F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(float(f)) * (F.col("n") - 1)).alias("place")) for i, f in enumerate(fractions)))
    wanted = sizes.select(*keys, F.explode(places).alias("p")).select(*keys, "p.i", "p.place")
    ends = F.array(F.floor("place"), F.ceil("place"))
    targets = wanted.select(*keys, "i", F.posexplode(ends).alias("side", "rank")).select(*keys, (2 * F.col("i") + F.col("side")).cast("int").alias("slot"), "rank")
    got = select_ranks(named, targets, keys, few).select(*keys, F.floor(F.col("slot") / 2).cast("int").alias("i"), (F.col("slot") % 2).alias("side"), "value")
    both = got.groupBy(*keys, "i").agg(F.max(F.when(F.col("side") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("value"))).alias("b"))
    part = F.col("place") - F.floor("place")
    line = both.join(wanted, [*keys, "i"]).select(*keys, "i", (F.col("a") + (F.col("b") - F.col("a")) * part).alias("q"))
    arrays = line.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "q"))).alias("q"))
    out = sizes.join(arrays, keys).select(*keys, "n", F.transform("q", lambda x: x["q"]).alias("q"))
    return out if by else out.drop("__all")


def hash_sample(df: DataFrame, sizes: DataFrame, by: str | Sequence[str], key: Sequence[str], seed: int | Column = 0, few: int = FEW) -> DataFrame:
    """Of each group the first `k` rows by a seeded hash of `key`; sizes: by, k. Groups of at most k rows stay whole. A seed may be a column.

    The hash of the last row that stays is selected, not sorted; rows that share it are taken in the order of `key`. Hashes
    are even, so that the k lowest lie almost surely below a little more than k / n of their range. Only these are looked at
    where they are k or more; groups in which they are fewer, for many equal rows, are looked at whole.
    """
    by = [by] if isinstance(by, str) else list(by)
    marked = df.withColumn("__h", F.xxhash64(seed if isinstance(seed, Column) else F.lit(seed), *key))
    counts = df.groupBy(*by).agg(F.count("*").alias("__n"))
    cut = staged(sizes.join(counts, by).filter("__n > k").select(*by, "k", "__n"), "cut")
    share = (F.col("k") + 8 * F.sqrt("k") + 32) / F.col("__n")
    limit = F.when(share < 1, ((F.least(share, F.lit(1.0 - 2**-20)) - 0.5) * 2.0**64).cast("long")).otherwise(F.lit(2**63 - 1))
    hashes = marked.select(*by, "__h").join(cut.filter("k > 0").select(*by, "k", limit.alias("__limit")), by)
    low = staged(hashes.filter("__h <= __limit").groupBy(*by, "k", "__h").agg(F.count("*").alias("c")), "low")
    found = low.groupBy(*by, "k").agg(F.sum("c").alias("n")).filter("n >= k").select(*by)
    short = cut.filter("k > 0").join(found, by, "left_anti").select(*by)
    values = low.select(*by, "__h", "c")
    if short.take(1):
        whole = hashes.join(short, by, "left_semi").groupBy(*by, "__h").agg(F.count("*").alias("c"))
        values = staged(values.join(short, by, "left_anti").unionByName(whole), "low")
    last = select_ranks(values.withColumnRenamed("__h", "v"), cut.filter("k > 0").select(*by, F.lit(0).alias("slot"), (F.col("k") - 1).alias("rank")), by, few)
    ends = cut.select(*by, "k").join(last.select(*by, F.col("value").alias("__end")), by, "left").withColumn("__cut", F.lit(True))
    ends = staged(ends, "ends")
    met = marked.join(ends, by, "left")
    plain = met.filter("__cut IS NULL OR __h < __end").select(*df.columns)
    # a hash is shared by equal rows alone, or nearly; a few rows of a group
    tied = met.filter("__h = __end")
    before = values.join(ends, by).filter("__h < __end").groupBy(*by).agg(F.sum("c").alias("__before"))
    first = Window.partitionBy(*by, "__part").orderBy(*key)
    limited = tied.withColumn("__part", F.spark_partition_id()).withColumn("__r", F.row_number().over(first)).filter("__r <= k")
    kept = limited.join(before, by, "left").withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*key)))
    return plain.unionByName(kept.filter("__r + coalesce(__before, 0) <= k").select(*df.columns))
