"""Bagged regression trees with a Bayesian ridge line in every leaf, for many scenes at once.

The trees of all scenes grow together: a job sums weights, targets and rows by (scene, tree, node, feature, bin), and
from these sums every scene finds the best splits of its open nodes. A tree grows best first: of its leaves that whose
split lowers the weighted squared error most is split next, until it has `max_leaves`. Which leaves that are is known once
the splits of all nodes on the way are, so a tree needs as many jobs as it is deep, not one for each split. Lines come
from sums over a leaf's rows. Samples lie in blocks, so that no task holds a scene; models are of bounded size.

A scene whose samples fill no more than one block has nothing to gain from jobs: the task that gets its block grows all
its trees there, in the same rounds and by the same rules, so that many small scenes need one shuffle of their samples.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import drop_staged, staged

#: Bins of a feature in a scene (between its quantiles; exact where it has fewer values), rows of a block of samples, and the side of one of cells.
BINS, BLOCK_ROWS, BLOCK_SIDE = 128, 4096, 128
MODEL = "trees array<struct<tree: int, node: int, feature: int, cut: double, left: int, right: int, value: double>>, lines array<struct<tree: int, leaf: int, coef: array<double>, intercept: double, ymin: double, ymax: double>>"
OPEN, SPLIT, SHUT = 0, 1, 2


@dataclass(frozen=True)
class Options:
    trees: int = 30
    rows: float = 0.8
    features: float = 0.8
    max_leaves: int = 30
    min_rows: int = 10
    seed: int = 0

    def drawn_features(self, n: int) -> list[np.ndarray]:
        """Of each tree, in ascending order."""
        k = max(1, int(self.features * n))
        return [np.sort(np.random.default_rng((self.seed, t)).permutation(n)[:k]) for t in range(self.trees)]

    def drawn_rows(self, ids: np.ndarray, n: int) -> np.ndarray:
        """How often each tree draws each row, by a hash of the row's id: a Poisson number of mean `rows`; a scene's only row once."""
        if n <= 1:
            return np.ones((self.trees, len(ids)), np.int64)
        with np.errstate(over="ignore"):
            salt = (np.arange(self.trees, dtype=np.uint64) + np.uint64(1000 * self.seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
            h = ids.astype(np.int64).view(np.uint64)[None, :] ^ salt[:, None]
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
        u = (h >> np.uint64(11)).astype(float) / (1 << 53)
        steps = np.cumsum(np.exp(-self.rows) * np.append(1.0, np.cumprod(self.rows / np.arange(1, 12))))
        return np.searchsorted(steps, u, "right")


class Tree:
    """Nodes by number, 0 the root: what is known of each, and its split if it has one."""

    def __init__(self):
        self.state, self.feature, self.cut, self.left, self.gain, self.value = [OPEN], [-1], [0.0], [-1], [0.0], [0.0]

    def add(self, state: int, value: float) -> int:
        for column, v in ((self.state, state), (self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.gain, 0.0), (self.value, value)):
            column.append(v)
        return len(self.state) - 1

    def grown(self, max_leaves: int) -> tuple[list[int], list[int]]:
        """The nodes that are split, best first, and open nodes that may have to be; their splits are left out for now."""
        heap, inner, unknown, leaves = [(0.0, 0)], [], [], 1
        while heap and leaves < max_leaves:
            _, node = heapq.heappop(heap)
            if self.state[node] == OPEN:
                unknown.append(node)
            elif self.state[node] == SPLIT:
                inner.append(node)
                leaves += 1
                for child in (self.left[node], self.left[node] + 1):
                    # an open node is looked at first
                    heapq.heappush(heap, (-self.gain[child] if self.state[child] == SPLIT else -np.inf if self.state[child] == OPEN else 0.0, child))
        return inner, unknown

    def leaf_of(self, x: np.ndarray, inner: Sequence[int]) -> np.ndarray:
        """The node of each row when only `inner` nodes are split."""
        at = np.zeros(len(x), np.int64)
        split, left = np.zeros(len(self.state), bool), np.array(self.left)
        split[list(inner)] = True
        feature, cut = np.array(self.feature), np.array(self.cut)
        live = np.arange(len(x)) if split[0] else np.zeros(0, np.int64)
        while len(live):
            node = at[live]
            at[live] = left[node] + (x[live, feature[node]] > cut[node])
            live = live[split[at[live]]]
        return at


def best_split(weight: np.ndarray, target: np.ndarray, rows: np.ndarray, min_rows: int) -> tuple[float, int, tuple] | None:
    """(gain, bin, (weights, sums) of both sides) of the best cut behind a bin, from the sums of a node's bins of one feature."""
    w, s, n = np.cumsum(weight), np.cumsum(target), np.cumsum(rows)
    good = (n >= min_rows) & (n[-1] - n >= min_rows) & (w > 0) & (w[-1] - w > 0)
    if not good.any():
        return None
    k = np.flatnonzero(good)
    gain = s[k] ** 2 / w[k] + (s[-1] - s[k]) ** 2 / (w[-1] - w[k]) - s[-1] ** 2 / w[-1]
    best = int(k[gain.argmax()])
    return float(gain.max()), best, (n[best], n[-1] - n[best], s[best] / w[best], (s[-1] - s[best]) / (w[-1] - w[best]))


def bayesian_ridges(n: np.ndarray, xx: np.ndarray, xy: np.ndarray, yy: np.ndarray, rounds: int = 300, tolerance: float = 1e-3, prior: float = 1e-6) -> np.ndarray:
    """Coefficients of many lines on centred features, each from its sums of products: noise and prior precision by evidence maximisation, gamma priors of shape and rate `prior`."""
    values, vectors = np.linalg.eigh(xx)
    values = np.maximum(values, 0.0)
    along = np.einsum("lji,lj->li", vectors, xy)
    noise, precision = 1.0 / (yy / n + np.finfo(float).eps), np.ones(len(n))
    solve = lambda i: np.einsum("lij,lj->li", vectors[i], along[i] / (values[i] + (precision[i] / noise[i])[:, None]))
    live, old = np.arange(len(n)), None
    for _ in range(rounds):
        coef = solve(live)
        error = np.maximum(0.0, yy[live] - 2 * (coef * xy[live]).sum(1) + np.einsum("li,lij,lj->l", coef, xx[live], coef))
        part = noise[live][:, None] * values[live]
        known = (part / (precision[live][:, None] + part)).sum(1)
        precision[live] = (known + 2 * prior) / ((coef * coef).sum(1) + 2 * prior)
        noise[live] = (n[live] - known + 2 * prior) / (error + 2 * prior)
        if old is not None:
            moving = ~(np.abs(old - coef).sum(1) < tolerance)
            live, coef = live[moving], coef[moving]
            if not len(live):
                break
        old = coef
    return solve(np.arange(len(n)))


# -- blocks of rows ------------------------------------------------------------------


def types(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def packed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], block: Column) -> DataFrame:
    """A row for each block of a scene: keys, n and its columns as doubles in `data`, missing values as NaN."""

    def pack(rows: pa.Table) -> pa.Table:
        data = np.stack([rows.column(c).to_numpy().astype(np.float64) for c in columns], 1)
        head = [rows.column(k).slice(0, 1).combine_chunks() for k in keys]
        return pa.table([*head, pa.array([len(data)], pa.int64()), pa.array([data.tobytes()], pa.binary())], names=[*keys, "n", "data"])

    wide = df.select(*keys, block.alias("__block"), *(F.col(c).cast("double").alias(c) for c in columns))
    return wide.groupBy(*keys, "__block").applyInArrow(pack, f"{types(df, keys)}, n long, data binary")


def unpacked(rows: pa.RecordBatch | pa.Table, columns: int) -> Iterator[tuple[int, np.ndarray]]:
    for i, raw in enumerate(rows.column("data").to_pylist()):
        yield i, np.frombuffer(raw, np.float64).reshape(-1, columns)


# -- growing ----------------------------------------------------------------------------


def sums_of_blocks(blocks: DataFrame, models: DataFrame, keys: Sequence[str], n_features: int, options: Options) -> DataFrame:
    """keys, tree, node, feature, bin and the sums w, wy, n there, for open nodes of all scenes."""
    drawn = options.drawn_features(n_features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data in unpacked(b, n_features + 3):
                scene = pickle.loads(b.column("__scene")[i].as_py())
                x, y, w, ids = data[:, :n_features], data[:, n_features] - scene["centre"][-1], data[:, n_features + 1], data[:, n_features + 2].view(np.int64)
                times = options.drawn_rows(ids, scene["n"])
                bins = [np.searchsorted(scene["edges"][f], x[:, f], "left") for f in range(n_features)]
                out = []
                for t, tree in enumerate(scene["trees"]):
                    inner, unknown = tree.grown(options.max_leaves)
                    if not unknown:
                        continue
                    place = np.full(len(tree.state), -1)
                    place[unknown] = np.arange(len(unknown))
                    at = place[tree.leaf_of(x, inner)]
                    own = np.flatnonzero((at >= 0) & (times[t] > 0))
                    weight = times[t][own] * w[own]
                    for f in drawn[t].tolist():
                        cell = at[own] * BINS + bins[f][own]
                        n = np.bincount(cell)
                        some = np.flatnonzero(n)
                        node = np.array(unknown)[some // BINS]
                        out.append(np.stack([np.full(len(some), t), node, np.full(len(some), f), some % BINS, np.bincount(cell, weight)[some], np.bincount(cell, weight * y[own])[some], n[some]], 1))
                # sums over no rows are whole numbers to bincount, whatever the weights
                table = np.concatenate(out).astype(np.float64) if out else np.zeros((0, 7))
                head = [b.column(k).take(pa.array(np.full(len(table), i))) for k in keys]
                whole = [pa.array(table[:, j].astype(np.int32)) for j in range(4)]
                yield pa.RecordBatch.from_arrays([*head, *whole, pa.array(table[:, 4]), pa.array(table[:, 5]), pa.array(table[:, 6])], names=[*keys, "tree", "node", "feature", "bin", "w", "wy", "n"])

    met = blocks.join(models.filter("__open").select(*keys, "__scene"), list(keys)).select(*keys, "__scene", "data")
    parts = met.mapInArrow(run, f"{types(blocks, keys)}, tree int, node int, feature int, bin int, w double, wy double, n double")
    return parts.groupBy(*keys, "tree", "node", "feature", "bin").agg(*(F.sum(c).alias(c) for c in ("w", "wy", "n")))


def with_splits(models: DataFrame, sums: DataFrame, keys: Sequence[str], options: Options) -> DataFrame:
    """Models whose open nodes have their best splits, or none."""

    def update(own: pa.Table, found: pa.Table) -> pa.Table:
        if not own.num_rows or not found.num_rows:
            return own
        scene = pickle.loads(own.column("__scene")[0].as_py())
        at = np.stack([found.column(c).to_numpy() for c in ("tree", "node", "feature", "bin")], 1).astype(np.int64)
        values = np.stack([found.column(c).to_numpy() for c in ("w", "wy", "n")])
        order = np.lexsort(at.T[::-1])
        at, values = at[order], values[:, order]
        edges = np.flatnonzero(np.append(True, (np.diff(at[:, :3], axis=0) != 0).any(1)))
        best: dict[tuple[int, int], tuple] = {}
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)], strict=True):
            tree, node, feature = at[a, :3].tolist()
            cut = best_split(*values[:, a:b], options.min_rows)
            total = values[:, a:b].sum(1)
            now = best.setdefault((tree, node), (0.0, None, None, None, total[1] / total[0] if total[0] else 0.0))
            if cut and cut[0] > now[0] + 1e-9 * abs(now[0]):
                here, k = scene["values"][feature], a + cut[1]
                # halfway to the next bin that has drawn rows in this node
                best[tree, node] = (cut[0], feature, float((here[at[k, 3]] + here[at[k + 1, 3]]) / 2), cut[2], now[4])
        for t, tree in enumerate(scene["trees"]):
            for node in sorted(tree.grown(options.max_leaves)[1]):
                gain, feature, cut, sides, value = best.get((t, node), (0.0, None, None, None, 0.0))
                tree.value[node] = value
                tree.state[node] = SHUT if feature is None else SPLIT
                if feature is not None:
                    tree.feature[node], tree.cut[node], tree.gain[node] = feature, cut, gain
                    tree.left[node] = len(tree.state)
                    for n, mean in ((sides[0], sides[2]), (sides[1], sides[3])):
                        tree.add(OPEN if n >= 2 * options.min_rows else SHUT, mean)
        still = any(tree.grown(options.max_leaves)[1] for tree in scene["trees"])
        head = [own.column(k).combine_chunks() for k in keys]
        return pa.table([*head, pa.array([pickle.dumps(scene)], pa.binary()), pa.array([still])], names=[*keys, "__scene", "__open"])

    return models.groupBy(*keys).cogroup(sums.groupBy(*keys)).applyInArrow(update, f"{types(models, keys)}, __scene binary, __open boolean")


def begun(samples: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, options: Options) -> DataFrame:
    """A model of bare roots for each scene: edges of bins, means, number of rows."""
    quantiles = [i / (BINS - 1) for i in range(BINS)]
    stats = samples.groupBy(*keys).agg(F.count("*").alias("n"), F.array(*(F.avg(c) for c in (*features, target))).alias("centre"), F.array(*(F.percentile_approx(f, quantiles, 20_000) for f in features)).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scenes = []
            for n, centre, at in zip(b.column("n").to_pylist(), b.column("centre").to_pylist(), b.column("at").to_pylist(), strict=True):
                values = [np.unique(v) for v in at]
                edges = [v[:-1] + np.diff(v) / 2 for v in values]
                scenes.append(pickle.dumps({"n": n, "centre": np.array(centre), "values": values, "edges": edges, "trees": [Tree() for _ in range(options.trees)]}))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(scenes, pa.binary()), pa.array([True] * len(scenes))], names=[*keys, "__scene", "__open"])

    return stats.mapInArrow(run, f"{types(samples, keys)}, __scene binary, __open boolean")


# -- lines -----------------------------------------------------------------------------


def lines_of(tree: np.ndarray, sums: np.ndarray, centre: np.ndarray, drawn: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients on all features and intercepts of leaves, from their trees, sums (n, y, yy, x, xy, and products of features, the later one first) and scenes' means."""
    k = len(drawn[0])
    n, y, yy, x, xy = sums[0], sums[1], sums[2], sums[3 : 3 + k].T, sums[3 + k : 3 + 2 * k].T
    xx = np.zeros((len(n), k, k))
    for at, (p, q) in enumerate((p, q) for p in range(k) for q in range(p + 1)):
        xx[:, p, q] = xx[:, q, p] = sums[3 + 2 * k + at]
    coef = bayesian_ridges(n, xx - x[:, :, None] * x[:, None, :] / n[:, None, None], xy - x * (y / n)[:, None], yy - y * y / n)
    own, whole = np.stack(drawn)[tree], np.zeros((len(n), centre.shape[1] - 1))
    np.put_along_axis(whole, own, coef, 1)
    return whole, centre[:, -1] + y / n - (coef * (x / n[:, None] + np.take_along_axis(centre, own, 1))).sum(1)


def leaf_lines(blocks: DataFrame, models: DataFrame, keys: Sequence[str], n_features: int, options: Options) -> DataFrame:
    """keys, tree, leaf, coef, intercept, ymin, ymax: the line through all of a leaf's rows, drawn or not, each counted once, on the tree's features."""
    drawn = options.drawn_features(n_features)
    k = len(drawn[0])
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    sums = ["n", "y", "yy", *(f"x{i}" for i in range(k)), *(f"xy{i}" for i in range(k)), *(f"xx{i}_{j}" for i, j in pairs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data in unpacked(b, n_features + 3):
                scene = pickle.loads(b.column("__scene")[i].as_py())
                x, y = data[:, :n_features] - scene["centre"][:-1], data[:, n_features] - scene["centre"][-1]
                out = []
                for t, tree in enumerate(scene["trees"]):
                    at, own = tree.leaf_of(data[:, :n_features], tree.grown(options.max_leaves)[0]), x[:, drawn[t]]
                    leaves, place = np.unique(at, return_inverse=True)
                    columns = [np.ones(len(y)), y, y * y, *own.T, *(own * y[:, None]).T, *(own[:, i] * own[:, j] for i, j in pairs)]
                    low, high = np.full(len(leaves), np.inf), np.full(len(leaves), -np.inf)
                    np.minimum.at(low, place, data[:, n_features])
                    np.maximum.at(high, place, data[:, n_features])
                    out.append(np.stack([np.full(len(leaves), t), leaves, low, high, *(np.bincount(place, c, len(leaves)) for c in columns)], 1))
                table = np.concatenate(out)
                head = [b.column(c).take(pa.array(np.full(len(table), i))) for c in keys]
                yield pa.RecordBatch.from_arrays([*head, pa.array(table[:, 0].astype(np.int32)), pa.array(table[:, 1].astype(np.int32)), *(pa.array(table[:, j]) for j in range(2, table.shape[1]))], names=[*keys, "tree", "leaf", "ymin", "ymax", *sums])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            centre = np.array(b.column("centre").to_pylist())
            coefs, starts = lines_of(b.column("tree").to_numpy(), np.stack([b.column(c).to_numpy() for c in sums]), centre, drawn)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*keys, "tree", "leaf")), pa.array(coefs.tolist(), pa.list_(pa.float64())), pa.array(starts), b.column("ymin"), b.column("ymax")], names=[*keys, "tree", "leaf", "coef", "intercept", "ymin", "ymax"])

    met = blocks.join(models.select(*keys, "__scene"), list(keys)).select(*keys, "__scene", "data")
    schema = f"{types(blocks, keys)}, tree int, leaf int, ymin double, ymax double, " + ", ".join(f"{c} double" for c in sums)
    every = met.mapInArrow(run, schema).groupBy(*keys, "tree", "leaf").agg(F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"), *(F.sum(c).alias(c) for c in sums))
    return every.join(centres(models, keys), list(keys)).mapInArrow(solve, f"{types(blocks, keys)}, tree int, leaf int, coef array<double>, intercept double, ymin double, ymax double")


def centres(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [pickle.loads(s)["centre"].tolist() for s in b.column("__scene").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(found, pa.list_(pa.float64()))], names=[*keys, "centre"])

    return models.select(*keys, "__scene").mapInArrow(run, f"{types(models, keys)}, centre array<double>")


def finished(models: DataFrame, lines: DataFrame, keys: Sequence[str], options: Options) -> DataFrame:
    """keys, trees, lines: a row for each scene."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            trees = []
            for s in b.column("__scene").to_pylist():
                scene, rows = pickle.loads(s), []
                for t, tree in enumerate(scene["trees"]):
                    inner = set(tree.grown(options.max_leaves)[0])
                    reached = [0, *(c for n in inner for c in (tree.left[n], tree.left[n] + 1))]
                    for n in sorted(reached):
                        split = n in inner
                        rows.append({"tree": t, "node": n, "feature": tree.feature[n] if split else -1, "cut": tree.cut[n], "left": tree.left[n] if split else -1, "right": tree.left[n] + 1 if split else -1, "value": tree.value[n] + float(scene["centre"][-1])})
                trees.append(rows)
            kind = pa.list_(pa.struct([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.float64()), ("left", pa.int32()), ("right", pa.int32()), ("value", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(trees, kind)], names=[*keys, "trees"])

    trees = models.select(*keys, "__scene").mapInArrow(run, f"{types(models, keys)}, {MODEL.split(', lines')[0]}")
    every = lines.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("tree", "leaf", "coef", "intercept", "ymin", "ymax"))).alias("lines"))
    return trees.join(every, list(keys))


# -- scenes of one block -------------------------------------------------------------------


def routed(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(tree, row): the leaf of every row in every tree; arrays are by (tree, node), feature -1 where a node isn't split."""
    trees, rows = len(feature), len(x)
    at = np.zeros(trees * rows, np.int64)
    tree, row = np.repeat(np.arange(trees), rows), np.tile(np.arange(rows), trees)
    live = np.flatnonzero(feature[tree, 0] >= 0)
    while len(live):
        t, node = tree[live], at[live]
        at[live] = np.where(x[row[live], feature[t, node]] <= cut[t, node], left[t, node], right[t, node])
        live = live[feature[t, at[live]] >= 0]
    return at.reshape(trees, rows)


class Grove:
    """The trees of one scene, whose samples are all at hand, grown together."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, ids: np.ndarray, options: Options, drawn: list[np.ndarray]):
        n, self.x, self.options, self.drawn = len(x), x, options, drawn
        ranks = np.maximum(1, np.ceil(np.array([i / (BINS - 1) for i in range(BINS)]) * n).astype(int)) - 1
        self.values = [np.unique(np.sort(v)[ranks]) for v in x.T]
        self.centre = np.append(x.mean(0), y.mean())
        self.y, self.w, self.times = y, w, options.drawn_rows(ids, n)
        self.bins = [np.searchsorted(v[:-1] + np.diff(v) / 2, own, "left") for v, own in zip(self.values, x.T, strict=True)]
        self.of_feature = [np.array([f in own for own in self.drawn]) for f in range(x.shape[1])]
        self.size = np.ones(options.trees, np.int64)
        self.state, self.feature, self.left = (np.full((options.trees, 64), v) for v in (SHUT, -1, -1))
        self.cut, self.gain, self.value = (np.zeros((options.trees, 64)) for _ in range(3))
        self.state[:, 0] = OPEN

    def grown(self) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """By (tree, node) the features of nodes that are split, -1 of others, and the open nodes; as Tree.grown."""
        feature, unknown = self.feature.copy(), []
        splits = (self.state == SPLIT).sum(1)
        for t in range(self.options.trees):
            if splits[t] + 1 < self.options.max_leaves:
                unknown += [(t, v) for v in np.flatnonzero(self.state[t] == OPEN).tolist()]
                continue
            tree = Tree()
            tree.state, tree.left, tree.gain = self.state[t].tolist(), self.left[t].tolist(), self.gain[t].tolist()
            inner, own = tree.grown(self.options.max_leaves)
            unknown += [(t, v) for v in sorted(own)]
            outer = np.ones(feature.shape[1], bool)
            outer[inner] = False
            feature[t, outer] = -1
        return feature, unknown

    def grow(self) -> np.ndarray:
        """By (tree, node) the features of the nodes that are split in the end."""
        while True:
            feature, unknown = self.grown()
            if not unknown:
                return feature
            self.split(unknown, routed(self.x, feature, self.cut, self.left, self.left + 1))

    def split(self, unknown: list[tuple[int, int]], at: np.ndarray) -> None:
        trees, nodes = np.array(unknown).T
        place = np.full(self.state.shape, -1)
        place[trees, nodes] = np.arange(len(unknown))
        mine = np.take_along_axis(place, at, 1)
        t, row = np.nonzero((mine >= 0) & (self.times > 0))
        seg, weight = mine[t, row], self.times[t, row] * self.w[row]
        target = weight * (self.y[row] - self.centre[-1])
        total, mass = np.bincount(seg, target, len(unknown)), np.bincount(seg, weight, len(unknown))
        mean = np.divide(total, mass, out=np.zeros(len(unknown)), where=mass != 0)
        best, found, cuts = np.zeros(len(unknown)), np.full(len(unknown), -1), np.zeros(len(unknown))
        sides = np.zeros((4, len(unknown)))
        for f, values in enumerate(self.values):
            some, width = self.of_feature[f][t], len(values)
            if width < 2 or not some.any():
                continue
            cell = seg[some] * width + self.bins[f][row[some]]
            size = len(unknown) * width
            rows = np.bincount(cell, minlength=size).reshape(-1, width)
            w, s, n = (np.cumsum(v.reshape(-1, width), 1) for v in (np.bincount(cell, weight[some], size), np.bincount(cell, target[some], size), rows))
            good = (n >= self.options.min_rows) & (n[:, -1:] - n >= self.options.min_rows) & (w > 0) & (w[:, -1:] - w > 0)
            with np.errstate(invalid="ignore", divide="ignore"):
                gains = np.where(good, s**2 / w + (s[:, -1:] - s) ** 2 / (w[:, -1:] - w) - s[:, -1:] ** 2 / w[:, -1:], -np.inf)
            k = gains.argmax(1)
            gain = gains[np.arange(len(k)), k]
            i = np.flatnonzero(gain > best + 1e-9 * np.abs(best))
            if not len(i):
                continue
            k = k[i]
            best[i], found[i] = gain[i], f
            # halfway to the next bin that has drawn rows in this node
            following = ((rows[i] > 0) & (np.arange(width) > k[:, None])).argmax(1)
            cuts[i] = (values[k] + values[following]) / 2
            sides[:, i] = n[i, k], n[i, -1] - n[i, k], s[i, k] / w[i, k], (s[i, -1] - s[i, k]) / (w[i, -1] - w[i, k])
        self.value[trees, nodes] = mean
        self.state[trees, nodes] = np.where(found >= 0, SPLIT, SHUT)
        i = np.flatnonzero(found >= 0)
        if not len(i):
            return
        t, v = trees[i], nodes[i]
        # `unknown` is in order of trees: a tree's children follow one another
        nth = np.arange(len(i)) - np.searchsorted(t, t)
        child = self.size[t] + 2 * nth
        while child.max() + 1 >= self.state.shape[1]:
            self.state, self.feature, self.left = (np.concatenate([a, np.full(a.shape, v)], 1) for a, v in ((self.state, SHUT), (self.feature, -1), (self.left, -1)))
            self.cut, self.gain, self.value = (np.concatenate([a, np.zeros(a.shape)], 1) for a in (self.cut, self.gain, self.value))
        self.feature[t, v], self.cut[t, v], self.gain[t, v], self.left[t, v] = found[i], cuts[i], best[i], child
        for side in (0, 1):
            self.state[t, child + side] = np.where(sides[side, i] >= 2 * self.options.min_rows, OPEN, SHUT)
            self.value[t, child + side] = sides[2 + side, i]
        self.size += 2 * np.bincount(t, minlength=len(self.size))

    def lines(self, feature: np.ndarray) -> dict[str, np.ndarray]:
        """tree, leaf, coef, intercept, ymin, ymax through all of a leaf's rows."""
        trees, n = self.options.trees, len(self.x)
        at = routed(self.x, feature, self.cut, self.left, self.left + 1)
        leaves, place = np.unique(np.arange(trees)[:, None] * feature.shape[1] + at, return_inverse=True)
        place = place.ravel()
        x, y = self.x - self.centre[:-1], np.tile(self.y - self.centre[-1], trees)
        own = [np.concatenate([x[:, f[i]] for f in self.drawn]) for i in range(len(self.drawn[0]))]
        columns = [np.ones(trees * n), y, y * y, *own, *(v * y for v in own), *(own[i] * own[j] for i in range(len(own)) for j in range(i + 1))]
        low, high = np.full(len(leaves), np.inf), np.full(len(leaves), -np.inf)
        np.minimum.at(low, place, np.tile(self.y, trees))
        np.maximum.at(high, place, np.tile(self.y, trees))
        tree, leaf = np.divmod(leaves, feature.shape[1])
        coef, start = lines_of(tree, np.stack([np.bincount(place, c, len(leaves)) for c in columns]), np.tile(self.centre, (len(leaves), 1)), self.drawn)
        return {"tree": tree, "leaf": leaf, "coef": coef, "intercept": start, "ymin": low, "ymax": high}

    def nodes(self, feature: np.ndarray) -> dict[str, np.ndarray]:
        """tree, node, feature, cut, left, right, value of all nodes that are reached."""
        inner, reached = feature >= 0, np.zeros(feature.shape, bool)
        t, v = np.nonzero(inner)
        reached[:, 0] = True
        reached[t, self.left[t, v]] = reached[t, self.left[t, v] + 1] = True
        t, v = np.nonzero(reached)
        split = inner[t, v]
        left = np.where(split, self.left[t, v], -1)
        return {"tree": t, "node": v, "feature": feature[t, v], "cut": self.cut[t, v], "left": left, "right": np.where(split, left + 1, -1), "value": self.value[t, v] + self.centre[-1]}


def fit_blocks(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], options: Options) -> DataFrame:
    """keys, trees, lines of scenes of at most BLOCK_ROWS samples: rows have keys, `columns` (features, target, weight) and `__id`."""
    k, whole = len(columns) - 2, ("tree", "node", "leaf", "feature", "left", "right")
    drawn = options.drawn_features(k)

    def nested(found: dict[str, np.ndarray]) -> pa.ListArray:
        n = len(found["tree"])
        arrays = [pa.array(v.astype(np.int32)) if c in whole else pa.ListArray.from_arrays(np.arange(0, v.size + 1, k, dtype=np.int32), pa.array(v.ravel())) if v.ndim == 2 else pa.array(v.astype(np.float64)) for c, v in found.items()]
        return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.StructArray.from_arrays(arrays, list(found)))

    def run(scene: pa.Table) -> pa.Table:
        ids = scene.column("__id").to_numpy().astype(np.int64)
        # sums don't depend on the order in which rows arrive
        data = np.stack([scene.column(c).to_numpy().astype(np.float64) for c in columns], 1)
        order = np.lexsort((*data.T, ids))
        data = data[order]
        grove = Grove(data[:, :k], data[:, k], data[:, k + 1], ids[order], options, drawn)
        feature = grove.grow()
        head = [scene.column(c).slice(0, 1).combine_chunks() for c in keys]
        return pa.table([*head, nested(grove.nodes(feature)), nested(grove.lines(feature))], names=[*keys, "trees", "lines"])

    # samples are few bytes for the work they make: by bytes alone they would be put together for few tasks
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *keys).groupBy(*keys).applyInArrow(run, f"{types(rows, keys)}, {MODEL}")


# -- fitting -----------------------------------------------------------------------------


def fit(samples: DataFrame, keys: Sequence[str], features: Sequence[str], ids: Sequence[str], target: str = "lst", weight: str = "weight", options: Options = Options()) -> DataFrame:
    """keys, trees, lines for every scene that has samples. `ids` tell a scene's rows apart: draws follow from them and the seed.

    Samples have no missing values. A scene of few rows has bare roots, whose line goes through all of them.
    """
    columns = [*features, target, weight]
    rows = staged(samples.select(*keys, *(F.col(c).cast("double").alias(c) for c in columns), F.xxhash64(*ids).alias("__id")), "rows")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > BLOCK_ROWS)
    large = staged(sizes, "large")
    if not large.take(1):
        return staged(fit_blocks(rows, keys, columns, options), "forest")
    small = fit_blocks(rows.join(large, list(keys), "left_anti"), keys, columns, options)
    return staged(small.unionByName(_fit_large(rows.join(large, list(keys)), keys, features, target, weight, options)), "forest")


def _fit_large(wide: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, weight: str, options: Options) -> DataFrame:
    n_features = len(features)
    at = begun(wide, keys, features, target, options)
    # an id's 64 bits travel as those of a double
    blocks = staged(_blocks(wide, keys, [*features, target, weight]), "samples")
    models, rest = staged(at, "models"), True
    while rest:
        grown = staged(with_splits(models, sums_of_blocks(blocks, models, keys, n_features, options), keys, options), "models")
        drop_staged(models)
        models, rest = grown, bool(grown.filter("__open").take(1))
    return finished(models, leaf_lines(blocks, models, keys, n_features, options), keys, options)


def _blocks(wide: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def pack(rows: pa.Table) -> pa.Table:
        data = [rows.column(c).to_numpy().astype(np.float64) for c in columns] + [rows.column("__id").to_numpy().astype(np.int64).view(np.float64)]
        head = [rows.column(k).slice(0, 1).combine_chunks() for k in keys]
        return pa.table([*head, pa.array([len(data[0])], pa.int64()), pa.array([np.stack(data, 1).tobytes()], pa.binary())], names=[*keys, "n", "data"])

    block = F.pmod(F.shiftright("__id", 20), F.ceil(F.col("__n") / BLOCK_ROWS))
    return wide.withColumn("__block", block).groupBy(*keys, "__block").applyInArrow(pack, f"{types(wide, keys)}, n long, data binary")


# -- applying ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """A scene's trees and lines as arrays by (tree, node)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    coef: np.ndarray
    intercept: np.ndarray
    ymin: np.ndarray
    ymax: np.ndarray

    @classmethod
    def read(cls, trees: pa.ListScalar, lines: pa.ListScalar) -> Model:
        nodes, leaves = trees.values, lines.values
        column = lambda a, c: a.field(c).to_numpy(zero_copy_only=False)
        at, of = (column(nodes, "tree"), column(nodes, "node")), (column(leaves, "tree"), column(leaves, "leaf"))
        shape = (at[0].max() + 1, at[1].max() + 1)
        grid = {c: np.full(shape, -1) for c in ("feature", "left", "right")} | {c: np.zeros(shape) for c in ("cut", "value", "intercept", "ymin", "ymax")}
        for c in ("feature", "cut", "left", "right", "value"):
            grid[c][at] = column(nodes, c)
        for c in ("intercept", "ymin", "ymax"):
            grid[c][of] = column(leaves, c)
        flat = leaves.field("coef").flatten().to_numpy(zero_copy_only=False)
        grid["coef"] = np.zeros((*shape, len(flat) // len(of[0])))
        grid["coef"][of] = flat.reshape(len(of[0]), -1)
        return cls(**grid)


#: Rows whose leaves in all trees are looked up at once.
PREDICT_ROWS = 2048


def predict(x: np.ndarray, model: Model, margin: float, plain: bool) -> np.ndarray:
    """The mean over trees of the leaf's line, kept within its range and `margin` of it; plain: of the leaf's value."""
    out, tree = np.zeros(len(x)), np.arange(len(model.feature))[:, None]
    for i in range(0, len(x), PREDICT_ROWS):
        own = x[i : i + PREDICT_ROWS]
        at = tree, routed(own, model.feature, model.cut, model.left, model.right)
        if plain:
            found = model.value[at]
        else:
            low, high = model.ymin[at], model.ymax[at]
            room = margin * (high - low)
            found = np.minimum(high + room, np.maximum(low - room, model.intercept[at] + (model.coef[at] * own).sum(2)))
        out[i : i + PREDICT_ROWS] = found.sum(0) / len(found)
    return out


def apply(cells: DataFrame, models: DataFrame, keys: Sequence[str], features: Sequence[str], margin: float = 0.25, plain: bool = False, side: int = BLOCK_SIDE) -> DataFrame:
    """keys, row, col, lst of the cells of scenes that have a model; a cell with a missing feature is missing. Cells are dealt once, in square blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data in unpacked(b, len(features) + 2):
                x = data[:, 2:]
                whole = ~np.isnan(x).any(1)
                lst = np.full(len(x), np.nan)
                if whole.any():
                    lst[whole] = predict(x[whole], Model.read(b.column("trees")[i], b.column("lines")[i]), margin, plain)
                head = [b.column(k).take(pa.array(np.full(len(x), i))) for k in keys]
                yield pa.RecordBatch.from_arrays([*head, pa.array(data[:, 0].astype(np.int32)), pa.array(data[:, 1].astype(np.int32)), pa.array(lst, mask=np.isnan(lst))], names=[*keys, "row", "col", "lst"])

    block = F.struct(F.floor(F.col("row") / side).alias("r"), F.floor(F.col("col") / side).alias("c"))
    blocks = packed(cells, keys, ["row", "col", *features], block)
    return blocks.join(models, list(keys)).select(*keys, "trees", "lines", "data").mapInArrow(run, f"{types(cells, keys)}, row int, col int, lst double")
