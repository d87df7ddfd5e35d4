"""Differences that the same sets have are one block: places and sums as if each shingle were looked up."""

import collections
import random

import numpy as np

from thermaspark.llm import jaccard
from thermaspark.llm.common import components


def family(k, part=200, parts=8, seed=0):
    """Sets that lack two or three of eight passages and have a few shingles of their own lacking."""
    r = random.Random(seed)
    out = {}
    for fp in range(k):
        gone = r.sample(range(parts), r.randint(2, 3))
        own = r.sample(range(part * parts), 3)
        out[fp] = {p * part + i for p in gone for i in range(part)} | set(own)
    return out


def test_blocks_hold_all_shared_differences(spark):
    sets = family(30)
    rows = spark.createDataFrame([(7, fp, 5, e) for fp, s in sets.items() for e in s], "head long, fp long, room int, e long")
    got = collections.defaultdict(list)
    for r in jaccard.placed_blocks(rows).collect():
        got[r["fp"]].append(((r["k"], r["one"], r["two"]), r["back"]))
    of = collections.defaultdict(set)
    for fp, s in sets.items():
        for e in s:
            of[e].add(fp)
    for fp, s in sets.items():
        shared = collections.Counter(frozenset(of[e]) for e in s if len(of[e]) > 1)
        places = sorted(got[fp])
        assert len(places) == len(shared) and places[0][1] == sum(shared.values())
        weights = [a[1] - b for a, b in zip(places, [x[1] for x in places[1:]] + [0], strict=True)]
        assert sorted(zip((x[0][0] for x in places), weights, strict=True)) == sorted((len(m), w) for m, w in shared.items())


def test_few_sets_meet_in_a_family(spark):
    """Sets that lack or replace passages of one head, all just too far from it: rows that meet, against one for each shared shingle."""
    met = {}
    for k in (40, 80, 160):
        r = np.random.default_rng(k)
        head, sets = np.arange(1600, dtype=np.uint64), {0: np.arange(1600, dtype=np.uint64)}
        for fp in range(1, k + 1):
            gone = r.choice(8, int(r.integers(2, 4)), replace=False)
            keep = np.array([e for e in head.tolist() if e // 200 not in gone], np.uint64)
            keep = np.delete(keep, r.choice(len(keep), 15, replace=False))
            new = np.concatenate([10_000 + 200 * int(g) + np.arange(int(r.integers(0, 200))) for g in gone[:1]])
            sets[fp] = np.unique(np.concatenate([keep, new.astype(np.uint64), 100_000 + 100 * fp + np.arange(15, dtype=np.uint64)]))
        frame = spark.createDataFrame([(fp, bytearray(s.tobytes())) for fp, s in sets.items()], "fp long, own binary")
        deltas = jaccard.differences(spark.createDataFrame([(0, fp) for fp in sets if fp], "head long, fp long"), frame).cache()
        labels = components(jaccard.answers(deltas, 80))
        _, placed = jaccard.places(deltas, labels)
        plain = collections.Counter(e for fp, s in sets.items() if fp for e in set(np.setxor1d(head, s).tolist()))
        met[k] = (jaccard.meeting(placed, 80).count(), sum(n * n for n in plain.values() if n > 1))
        link = lambda s, t: 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))
        found = {frozenset((x["a"], x["b"])) for x in jaccard.derived(deltas, labels, 80).collect()}
        want = {frozenset((a, b)) for a in sets for b in sets if 0 < a < b and link(sets[a], sets[b])}
        joined = {x["node"]: x["component"] for x in labels.collect()}
        assert found <= want and all(p in found or len({joined.get(x, x) for x in p}) == 1 for p in want)
        deltas.unpersist()
    assert all(few * 50 < plain for few, plain in met.values()), met
