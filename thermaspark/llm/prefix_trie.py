"""The trie of conversations that begin alike: members, children, leaves and what sharing saves, by balanced parentheses.

Only turns that several conversations share, and the first turn behind them, enter a trie; what follows is a chain of
its conversation alone. Prefixes are told apart by the XOR of a keyed hash of every turn and its place, which adds up in
blocks, so that one long conversation is no single task. Paths are sorted and cut into shards by range, each a stretch of
the trie in depth-first order. A shard writes its stretch as balanced parentheses with the least and greatest excess of
every block: findclose delimits subtrees, ranks of leaf pairs count leaves, cumulative arrays give members and savings.
Only the paths at a shard's two ends, its spines, can go on in other shards; they carry what hangs on them and merge, a
bounded number of shards at a time, until one stretch is left.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Turns of a conversation that one task adds up, items of paths in a shard, shards whose spines merge at once.
BLOCK, SHARD, FAN = 1024, 50_000, 256
#: Conversations whose first turns are replaced by those of one, and the number of ways to do so.
FAMILY, WAYS = 100, 6
#: Bits of a block of parentheses.
BITS = 64

ITEM = "struct<rep: bigint, cp: bigint, members: bigint, leaves: bigint, saved: bigint, kids: bigint>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
SCHEMA = f"shard long, side int, path array<{ITEM}>, {NODE}"
HANGING = ("members", "leaves", "saved", "kids")


# -- balanced parentheses --------------------------------------------------------


class Parentheses:
    """A forest in depth-first order: 1 opens a node, 0 closes it."""

    def __init__(self, bits: np.ndarray):
        n = -(-max(1, len(bits)) // BITS)
        self.size = 1 << max(0, n - 1).bit_length()
        excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        last = excess[-1] if len(excess) else 0
        self.blocks = np.append(excess, np.full(self.size * BITS - len(excess), last + 1)).reshape(-1, BITS)
        self.excess = excess
        self.least, self.most = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        self.least[self.size :], self.most[self.size :] = self.blocks.min(1), self.blocks.max(1)
        for at in (1 << k for k in range(self.size.bit_length() - 2, -1, -1)):
            self.least[at : 2 * at] = self.least[2 * at : 4 * at].reshape(-1, 2).min(1)
            self.most[at : 2 * at] = self.most[2 * at : 4 * at].reshape(-1, 2).max(1)

    def _first(self, block: np.ndarray, goal: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The first place in each block, beyond `after`, where the excess is `goal`; -1 if there is none."""
        out = np.empty(len(block), np.int64)
        for a in range(0, len(block), 4096):
            part = slice(a, a + 4096)
            met = (self.blocks[block[part]] == goal[part, None]) & (np.arange(BITS) > after[part, None])
            out[part] = np.where(met.any(1), met.argmax(1), -1)
        return out

    def _holds(self, node: np.ndarray, goal: np.ndarray) -> np.ndarray:
        return (self.least[node] <= goal) & (goal <= self.most[node])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the nodes that open at these places close."""
        goal, block = self.excess[opens] - 1, opens // BITS
        near = self._first(block, goal, opens % BITS)
        out = block * BITS + near
        far = np.flatnonzero(near < 0)
        node, wanted = self.size + block[far], goal[far]
        up = np.arange(len(far))
        while len(up):  # to the next block on the right that reaches the excess: up to a node with such a sibling,
            right = (node[up] % 2 == 0) & self._holds(np.minimum(node[up] + 1, 2 * self.size - 1), wanted[up])
            node[up] = np.where(right, node[up] + 1, node[up] // 2)
            up = up[~right]
        down = np.flatnonzero(node < self.size)
        while len(down):  # and down to its first such block
            left = 2 * node[down]
            node[down] = np.where(self._holds(left, wanted[down]), left, left + 1)
            down = down[node[down] < self.size]
        block = node - self.size
        out[far] = block * BITS + self._first(block, wanted, np.full(len(far), -1))
        return out


class Paths(NamedTuple):
    """Sorted paths from the root, one after another, with what hangs on their items besides the paths."""

    at: np.ndarray
    rep: np.ndarray
    cp: np.ndarray
    hang: dict[str, np.ndarray]


class Trie:
    """Nodes in depth-first order: rep, depth, parent (number, -1: none), and the sums over their subtrees."""

    def __init__(self, paths: Paths, ends: bool):
        """ends: nodes of the first and the last path may go on elsewhere."""
        at, n = paths.at, len(paths.at) - 1
        size = np.diff(at)
        unit, item = np.repeat(np.arange(n), size), np.arange(at[-1])
        depth = item - at[unit]
        before = np.maximum(unit - 1, 0)
        same = (unit > 0) & (depth < size[before])
        same &= paths.rep == paths.rep[np.where(same, at[before] + depth, 0)]
        misses = np.append(0, np.cumsum(~same))
        shared = misses[1:] == misses[at[unit]]
        common = np.add.reduceat(shared.astype(np.int64), at[:-1])
        fresh = ~shared
        number = np.cumsum(fresh) - 1
        order = np.lexsort((item, depth))
        latest = np.maximum.accumulate(np.where(fresh[order], np.arange(len(order)), 0))
        node = np.empty(len(item), np.int64)
        node[order] = number[order[latest]]
        self.of_item, self.at = node, at
        new = np.flatnonzero(fresh)
        self.rep, self.cp, self.depth = paths.rep[new], paths.cp[new], depth[new]
        self.parent = np.where(self.depth > 0, node[np.maximum(new - 1, 0)], -1)
        count = len(new)
        hang = {k: np.bincount(node, v, count).astype(np.int64) for k, v in paths.hang.items()}

        runs = np.empty(2 * n, np.int64)
        runs[0::2] = size - common
        runs[1::2] = size - np.append(common[1:], 0)
        bits = np.repeat(np.tile(np.array([1, 0], np.int8), n), runs)
        opens = np.flatnonzero(bits)
        closes = Parentheses(bits).findclose(opens)
        first, behind = np.arange(count), np.arange(count) + (closes - opens + 1) // 2
        total = lambda v: (s := np.append(0, np.cumsum(v)))[behind] - s[first]

        self.ends = np.zeros(count, bool)
        if ends:
            self.ends[node[at[0] : at[1]]] = self.ends[node[at[-2] : at[-1]]] = True
        self.members = total(hang["members"])
        self.kids = np.bincount(self.parent[self.parent >= 0], minlength=count) + hang["kids"]
        pair = np.zeros(len(bits), np.int64)
        pair[opens] = (closes == opens + 1) & (hang["kids"] == 0) & ~self.ends
        rank = np.append(0, np.cumsum(pair))
        self.leaves = rank[closes + 1] - rank[opens] + total(hang["leaves"])
        self.saved = total(hang["saved"] + np.where(self.ends, 0, (self.members - 1) * self.cp))

    def finished(self) -> dict[str, np.ndarray]:
        done = np.flatnonzero(~self.ends)
        parent = self.parent[done]
        return {
            "conv_id": self.rep[done],
            "depth": self.depth[done],
            "parent_conv_id": np.ma.array(self.rep[np.maximum(parent, 0)], mask=parent < 0),
            "n_convs": self.members[done],
            "n_children": self.kids[done],
            "n_leaves": self.leaves[done],
            "saved_tokens": self.saved[done],
        }

    def spines(self) -> list[np.ndarray]:
        """Of the first and the last path the items as ITEM has them, with what hangs on each of their nodes."""
        inner = np.flatnonzero(self.ends & (self.parent >= 0))
        less = lambda v: v - np.bincount(self.parent[inner], v[inner], len(v)).astype(np.int64)
        table = np.stack([self.rep, self.cp, less(self.members), less(self.leaves), less(self.saved), self.kids - np.bincount(self.parent[inner], minlength=len(self.kids))], 1)
        left, right = self.of_item[: self.at[1]], self.of_item[self.at[-2] :]
        last = table[right].copy()
        last[np.isin(right, left), 2:] = 0
        return [table[left]] if len(self.at) == 2 else [table[left], last]


# -- Spark ------------------------------------------------------------------------


def result(shard: int, trie: Trie, ends: bool) -> pa.Table:
    done = trie.finished()
    spines = trie.spines() if ends else []
    n, k = len(done["depth"]), len(spines)
    items = np.concatenate(spines) if k else np.zeros((0, 6), np.int64)
    names = ["rep", "cp", *HANGING]
    path = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(s) for s in spines])), pa.int32()), pa.StructArray.from_arrays([pa.array(items[:, i]) for i in range(6)], names))
    columns = [pa.array([shard] * (n + k), pa.int64()), pa.array([0] * n + list(range(k)), pa.int32()), pa.concat_arrays([pa.nulls(n, path.type), path])]
    for v in done.values():
        own = pa.array(np.ma.getdata(v), pa.int64(), mask=np.ma.getmaskarray(v))
        columns.append(pa.concat_arrays([own, pa.nulls(k, pa.int64())]))
    return pa.table(columns, names=["shard", "side", "path", *done])


def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard of sorted paths (path, members, tails) that lies in one partition."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    path = rows.column("path").combine_chunks()
    flat, at = path.flatten(), np.append(0, np.cumsum(pa.compute.list_value_length(path).to_numpy())).astype(np.int64)
    hang = {k: np.zeros(at[-1], np.int64) for k in HANGING}
    hang["members"][at[1:] - 1] = rows.column("members").to_numpy()
    hang["leaves"][at[1:] - 1] = hang["kids"][at[1:] - 1] = rows.column("tails").to_numpy()
    field = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
    out = result(TaskContext.get().partitionId(), Trie(Paths(at, field("rep"), field("cp"), hang), True), True)
    yield from out.to_batches()


def merge(top: bool):
    """Of neighbouring shards: their spines as sorted paths."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("shard", "ascending"), ("side", "ascending")]).combine_chunks()
        path = rows.column("path").combine_chunks()
        flat, at = path.flatten(), np.append(0, np.cumsum(pa.compute.list_value_length(path).to_numpy())).astype(np.int64)
        field = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
        trie = Trie(Paths(at, field("rep"), field("cp"), {k: field(k) for k in HANGING}), not top)
        return result(rows.column("group")[0].as_py(), trie, not top)

    return run


def tries(paths: DataFrame, shards: int, fan: int = FAN) -> list[DataFrame]:
    """The nodes of sorted distinct paths (path array of structs, the root first; members; tails) that end as they say."""
    level = staged(paths.repartitionByRange(shards, "path").sortWithinPartitions("path").mapInArrow(shard_of, SCHEMA), "trie")
    out, top = [], False
    while not top:
        out.append(level.filter("path IS NULL").select(*(c.split()[0] for c in NODE.split(", "))))
        spines = level.filter("path IS NOT NULL")
        last = spines.agg(F.max("shard")).first()[0]
        if last is None:
            break
        top = last < fan
        grouped = spines.select(F.floor(F.col("shard") / fan).alias("group"), "shard", "side", "path")
        level = staged(grouped.groupBy("group").applyInArrow(merge(top), SCHEMA), "trie")
        if top:
            out.append(level.select(*(c.split()[0] for c in NODE.split(", "))))
    return out


def lanes(key: str, place: Column, digest: Column) -> list[Column]:
    """Two 60-bit values of a keyed hash of a turn at its place."""
    h = F.sha2(F.concat(F.lit(key), place.cast("string"), F.lit(":"), digest), 256)
    return [F.conv(F.substring(h, i, 15), 16, 10).cast("long") for i in (1, 16)]


def indexed(turns: DataFrame, partitions: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, i, digest, cp) with places from 1 by turn, nulls first, and then digest; (conv_id, n).

    Rows are sorted by range, so that a conversation of any length is spread, and numbered in their partitions; numbers
    of rows per conversation and partition give the rest.
    """
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("salt")]
    sort = turns.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    rows = staged(sort.select("conv_id", "digest", "cp", F.monotonically_increasing_id().alias("at")), "turns").withColumn("part", F.shiftright("at", 33))
    own = staged(rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")), "stretches")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = own.select("conv_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    placed = rows.join(start, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("i"), "digest", "cp")
    return staged(placed, "places"), own.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(conversations: DataFrame, partitions: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, cp) of the rebuilt conversations' turns, and (conv_id, size) of all of them."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("cp"))
    rows, sizes = indexed(turns, partitions)
    named = sizes.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % WAYS, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    of_base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = named.join(of_base, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("b"), "n")
    plan = staged(plan.withColumn("size", F.col("b") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "plan")
    own = rows.join(plan.select("conv_id", "h", "b"), "conv_id").filter("i > h").select("conv_id", (F.col("i") - F.col("h") + F.col("b")).alias("pos"), "digest", "cp")
    # at most five rows of a conversation, for the conversations of its family
    heads = rows.filter((F.col("i") < WAYS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    lent = plan.filter("b > 0").select("conv_id", "base", "b").join(heads, "base").filter("i <= b").select("conv_id", F.col("i").alias("pos"), "digest", "cp")
    return own.unionByName(lent), plan.select("conv_id", "size")


def prefix_trie(conversations: DataFrame, shard: int = SHARD, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """A row for each distinct sequence of first turns of the rebuilt conversations, the empty one included.

    Defined results: rows without conv_id belong to no conversation; null turns come first; turns of equal number are
    ordered by a hash of role and text, and count each; null roles and texts are empty; an empty table has no nodes;
    other columns are ignored. ends_sha256 needs a node's ids in one string, the one value here that grows with a node.
    """
    spark = conversations.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns, convs = rebuilt(conversations, partitions)
    root = convs.agg(F.min("conv_id")).first()[0]

    key = secrets.token_hex(16)
    x, y = lanes(key, F.col("pos"), F.col("digest"))
    marked = staged(turns.select("conv_id", "pos", F.floor((F.col("pos") - 1) / block).alias("block"), "cp", x.alias("x"), y.alias("y")), "marked")
    inside = Window.partitionBy("conv_id", "block").orderBy("pos")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda name, w: F.expr(f"bit_xor({name})").over(w)
    sums = marked.groupBy("conv_id", "block").agg(F.expr("bit_xor(x)").alias("bx"), F.expr("bit_xor(y)").alias("by"))
    sums = sums.select("conv_id", "block", xor("bx", earlier).alias("bx"), xor("by", earlier).alias("by")).filter("block > 0")
    running = marked.select("conv_id", "pos", "block", "cp", xor("x", inside).alias("x"), xor("y", inside).alias("y")).join(sums, ["conv_id", "block"], "left")
    joined = lambda a, b: F.col(a).bitwiseXOR(F.coalesce(b, F.lit(0))).alias(a)
    prefixes = staged(running.select("conv_id", "pos", "cp", joined("x", "bx"), joined("y", "by")), "prefixes")

    nodes = prefixes.groupBy("pos", "x", "y").agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"))
    met = staged(prefixes.join(nodes, ["pos", "x", "y"]).select("conv_id", "pos", "cp", "n", "rep"), "met")
    shared = met.groupBy("conv_id").agg(F.max(F.when(F.col("n") > 1, F.col("pos")).otherwise(0)).alias("shared"))
    known = staged(convs.join(shared, "conv_id", "left").withColumn("shared", F.coalesce("shared", F.lit(0))), "known")
    at = met.join(known, "conv_id")
    alone = at.filter("pos > shared + 1").select("conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), (F.col("pos") < F.col("size")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))

    top = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(root).cast("long").alias("rep"), F.lit(0).cast("long").alias("cp"))
    item = F.struct(F.col("pos").cast("long").alias("pos"), F.col("rep").cast("long").alias("rep"), F.col("cp").cast("long").alias("cp"))
    own = at.filter("pos <= shared + 1").groupBy("conv_id", "size").agg(F.sort_array(F.collect_list(item)).alias("items"))
    none = known.filter("size = 0").select("conv_id", "size", F.expr("CAST(array() AS array<struct<pos: bigint, rep: bigint, cp: bigint>>)").alias("items"))
    paths = own.unionByName(none).select("conv_id", F.concat(F.array(top), "items").alias("path"), (F.col("size") > F.size("items")).cast("long").alias("tail"))
    paths = staged(paths, "paths")
    distinct = staged(paths.groupBy("path").agg(F.count("*").alias("members"), F.sum("tail").alias("tails")), "distinct")
    items = distinct.agg(F.coalesce(F.sum(F.size("path")), F.lit(0))).first()[0]
    found = tries(distinct, max(partitions, -(-items // shard)), fan)
    every = alone
    for part in found:
        every = every.unionByName(part)

    last = F.element_at("path", -1)
    ends = paths.filter("tail = 0").select("conv_id", last["rep"].alias("rep"), last["pos"].alias("depth"))
    chains = known.filter("size > shared + 1").select("conv_id", F.col("conv_id").alias("rep"), F.col("size").alias("depth"))
    listed = ends.unionByName(chains).groupBy("rep", "depth").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    listed = listed.select(F.col("rep").alias("conv_id"), "depth", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("own"))
    out = every.join(listed, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("own", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


ORACLE = """
WITH o AS (SELECT conv_id AS c, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, ''))) AS i, {'role': COALESCE(role, ''), 'text': COALESCE(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(t ORDER BY i) AS ts, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda v, b: list_reduce(list_concat([xor(v, b)], range(8)), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))) % 6 AS h FROM o GROUP BY 1),
r AS (SELECT l.c, list_concat(COALESCE(b.ts, [])[1:l.h], l.ts[l.h+1:]) AS ts FROM l LEFT JOIN l b ON b.c = l.c - l.c % 100),
m AS (SELECT c, d, ts[1:d] AS k, len(ts) AS n FROM (SELECT c, ts, unnest(range(len(ts)+1)) AS d FROM r)),
g AS (SELECT k, d, MIN(c) AS conv_id, COUNT(*) AS n_convs, BOOL_AND(n = d) AS leaf, COALESCE(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ids FROM m GROUP BY 1, 2),
p AS (SELECT a.conv_id, a.d, COUNT(*) FILTER (b.d = a.d + 1) AS n_children, COUNT(*) FILTER (b.leaf) AS n_leaves, CAST(SUM(CASE WHEN b.d = 0 THEN 0 ELSE (b.n_convs-1)*length(b.k[-1].text) END) AS BIGINT) AS saved_tokens FROM g a JOIN g b ON b.d >= a.d AND b.k[1:a.d] = a.k GROUP BY 1, 2)
SELECT g.conv_id, g.d AS depth, u.conv_id AS parent_conv_id, g.n_convs, n_children, n_leaves, saved_tokens, sha256(g.ids) AS ends_sha256 FROM g JOIN p ON p.conv_id = g.conv_id AND p.d = g.d LEFT JOIN g u ON u.d = g.d - 1 AND g.d > 0 AND u.k = g.k[1:g.d-1]
"""
