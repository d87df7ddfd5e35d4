"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

An item leaks into a document if at least HUNDREDTHS percent of its distinct shingles are among the document's. Shingles
that no item has cannot count, so texts are first cut down to the shingles of the benchmark (a semi-join); what is left
of a text is small, whatever its length. These rests are partitioned by size; the larger a partition's sets, the lower
the Jaccard similarity that the containment implies and the more MinHash values are compared, so that a leak is missed
with a probability of at most MISS. Where that would ask for more than MOST_VALUES values (items of few shingles in
large rests, rests beyond the last partition), items and rests meet by their shingles instead. Either way candidates
are verified by exact containment, and none is dropped.

Words are the lower-cased text between white space (space, \\t to \\r); shingles are runs of five words. An item of fewer
words is one shingle, which is looked for inside documents as a run of that many words. Defined results: null and empty
texts have no shingles; rows that share an item_id are one item with all their shingles; documents that share a doc_id
have a row for every pair of a text and an item; repeated rows count once; rows without a match give none; empty tables
give none; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, staged

WIDTH, HUNDREDTHS, MISS = 5, 80, 1e-6
#: Sizes of a text's rest in each partition, up to the value given.
PARTITIONS = (16, 32, 64, 128, 256, 512, 1024)
#: MinHash values of a set; beyond them it meets items by its shingles.
MOST_VALUES = 256
#: Shingles of the benchmark, and texts with leaks, that may be broadcast, 16 bytes each.
MOST_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def runs(words: Column, width: int) -> Column:
    """Hashes of all runs of `width` words."""
    starts = F.sequence(F.lit(0), F.size(words) - width)
    return F.when(F.size(words) >= width, F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width))))).otherwise(F.array().cast("array<long>"))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """(item_id, h, width) of every distinct shingle."""
    words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text").cast("string")).alias("w"))
    words = words.withColumn("width", F.least(F.size("w"), F.lit(WIDTH)))
    own = F.coalesce(*(F.when(F.col("width") == k, runs(F.col("w"), k)) for k in range(1, WIDTH + 1)))
    return words.select("item_id", F.explode(own).alias("h"), "width").distinct()


def values_for(most: int, item: int, hundredths: int) -> int:
    """MinHash values to compare between items of at least `item` shingles and sets of at most `most`."""
    shared = hundredths / 100 * item
    similarity = shared / (most + item - shared)
    return math.ceil(math.log(MISS) / math.log(max(1e-12, 1 - similarity))) if similarity < 1 else 1


def minhashes(sets: DataFrame, ids: list[str], many: Column) -> DataFrame:
    """(ids, i, low): for i below `many`, the smallest i-th hash of sets(ids, hs)."""
    low = lambda i: F.struct(i.alias("i"), F.array_min(F.transform("hs", lambda h: F.xxhash64(h, i))).alias("low"))
    return sets.filter(many > 0).select(*ids, F.explode(F.transform(F.sequence(F.lit(0), many - 1), low)).alias("x")).select(*ids, "x.i", "x.low")


def found(docs: DataFrame, benchmark: DataFrame, hundredths: int = HUNDREDTHS) -> DataFrame:
    """(key, item_id, shared, n_item) of texts and items; key is the text's xxhash64."""
    items = staged(item_shingles(benchmark), "items")
    sized = items.groupBy("item_id").agg(F.countDistinct("h").alias("n_item"))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most WIDTH
    items = staged(items.select("item_id", "h").distinct().join(sized, "item_id").withColumn("c", F.floor(F.log2(F.col("n_item").cast("double"))).cast("int")), "items")
    universe = bounded(items.select("h").distinct(), MOST_BROADCAST)
    text = F.col("text").cast("string")
    words = docs.select(F.xxhash64(text).alias("key"), words_of(text).alias("w"))
    every = words.select("key", F.explode(F.concat(F.array().cast("array<long>"), *(runs(F.col("w"), k) for k in widths))).alias("h"))
    rest = staged(every.join(universe, "h", "left_semi").distinct(), "rest")
    sets = rest.groupBy("key").agg(F.count("*").alias("n"))
    part = F.lit(len(PARTITIONS))
    for p in reversed(range(len(PARTITIONS))):
        part = F.when(F.col("n") <= PARTITIONS[p], F.lit(p)).otherwise(part)
    sets = staged(sets.select("key", part.alias("p")), "sizes")
    # classes of item sizes by powers of two, at most 31: the values to compare follow from a class's smallest item
    classes = [r[0] for r in items.select("c").distinct().collect()]
    need = {(p, c): v for p, most in enumerate(PARTITIONS) for c in classes if (v := values_for(most, 1 << c, hundredths)) <= MOST_VALUES}
    hashed = lambda p, c: F.coalesce(*(F.when((p == i) & (c == k), F.lit(v)) for (i, k), v in need.items()), F.lit(0))
    most = lambda x, which: F.coalesce(*(F.when(x == k, F.lit(max(v for pc, v in need.items() if pc[which] == k))) for k in sorted({pc[which] for pc in need})), F.lit(0))
    small = rest.join(sets.filter(most(F.col("p"), 0) > 0), "key").groupBy("key", "p").agg(F.collect_list("h").alias("hs"))
    lows = minhashes(small, ["key", "p"], most(F.col("p"), 0))
    item_lows = minhashes(items.filter(most(F.col("c"), 1) > 0).groupBy("item_id", "c").agg(F.collect_list("h").alias("hs")), ["item_id", "c"], most(F.col("c"), 1))
    pairs = lows.join(item_lows, ["i", "low"]).filter(F.col("i") < hashed(F.col("p"), F.col("c"))).select("key", "item_id")
    plain = rest.join(sets, "key").join(items, "h").filter(hashed(F.col("p"), F.col("c")) == 0).select("key", "item_id")
    pairs = pairs.unionByName(plain).distinct()
    exact = pairs.join(rest, "key").join(items.select("item_id", "h", "n_item"), ["item_id", "h"]).groupBy("key", "item_id", "n_item").agg(F.count("*").alias("shared"))
    return exact.filter(F.col("shared") * 100 >= F.col("n_item") * hundredths)


def leaks(docs: DataFrame, benchmark: DataFrame, hundredths: int = HUNDREDTHS) -> DataFrame:
    """doc_id, item_id, shared, n_item: distinct shingles in both, and in the item."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("key"))
    return own.join(bounded(found(docs, benchmark, hundredths), MOST_BROADCAST), "key").distinct().select("doc_id", "item_id", "shared", "n_item")


def without_leaks(docs: DataFrame, benchmark: DataFrame, hundredths: int = HUNDREDTHS) -> DataFrame:
    """docs whose text holds no item, whatever their doc_id; a null text holds none."""
    gone = bounded(found(docs, benchmark, hundredths).select(F.col("key").alias("__leak_key")).distinct(), MOST_BROADCAST)
    return docs.join(gone, F.xxhash64(F.col("text").cast("string")) == F.col("__leak_key"), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id AS id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
k AS (SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT id, array_to_string(w[i:i+k-1], ' ') AS s FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)),
bs AS (SELECT DISTINCT id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS shared, any_value(n.n) AS n_item
FROM ds JOIN bs USING (s) JOIN n ON n.id = bs.id GROUP BY ds.id, bs.id HAVING 100 * count(*) >= 80 * any_value(n.n)"""
