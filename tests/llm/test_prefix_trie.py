"""Parentheses against a stack, the trie against a plain one and against SQL, whatever the shards, and the query's cases."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from thermaspark.llm import prefix_trie as T

from ..conftest import DATA

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("n", [1, 2, 7, 64, 65, 400, 5000])
@pytest.mark.parametrize("deep", [0.3, 0.5, 0.8])
def test_findclose(n, deep):
    r, bits, level, left = random.Random(n), [], 0, n
    while left or level:
        if left and (not level or r.random() < deep):
            bits, level, left = [*bits, 1], level + 1, left - 1
        else:
            bits, level = [*bits, 0], level - 1
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = np.flatnonzero(bits)
    assert T.Parentheses(np.array(bits, np.int8)).findclose(opens).tolist() == [want[i] for i in opens.tolist()]


def plain(rows):
    own = collections.defaultdict(list)
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    turns = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        full[c] = tuple(turns.get(base, [])[:h] + ts[h:])
    members = collections.defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    leaf = {k for k, m in members.items() if all(len(full[c]) == len(k) for c in m)}
    out = set()
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        ends = ",".join(str(c) for c in m if len(full[c]) == len(k))
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        out.add((m[0], len(k), members[k[:-1]][0] if k else None, len(m), sum(len(x) == len(k) + 1 for x in below), sum(x in leaf for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def odd_rows(seed, convs=60):
    r = random.Random(seed)
    rows = [(None, 1, "user", "nobody's"), (100, None, None, None), (100, 1, "user", "é😀"), (7, 1, "user", "only"), (-5, 2, "user", "x"), (-100, 1, "user", "base below zero")]
    for c in [0, 200, *r.sample(range(1, 800), convs), 300, 301, 302]:
        for t in range(r.choice([1, 1, 2, 3, 6, 9])):
            rows.append((c, t, r.choice(["user", "assistant"]) if t > 1 else "user", r.choice(["a", "b", "c"]) * (t + 1)))
    rows += [(305, t, "user", f"long {t}") for t in range(70)] + [(306, t, "user", f"long {t}") for t in range(66)]
    rows += [(c, t, "user", "copy") for c in (400, 401, 402, 403, 404) for t in range(7)]
    return [*rows, (307, 1, "user", "tie"), (307, 1, "user", "eit"), (307, 1, "user", "tie"), (308, 5, "user", None)]


@pytest.mark.parametrize("seed,shard,fan,block", [(1, 50_000, 256, 1024), (2, 20, 2, 4), (3, 5, 3, 1)])
def test_trie_equals_a_plain_one(spark, seed, shard, fan, block):
    rows = odd_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS pos", "'x' AS path", "3 AS n").repartition(5)
    got = [tuple(r) for r in T.prefix_trie(df, shard, fan, block).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_sql_equals_a_plain_trie(spark, tmp_path):
    rows = odd_rows(4, 30)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/c.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c.parquet/*.parquet')")
    got = con.sql(f"SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM ({T.ORACLE})").fetchall()
    assert set(got) == plain(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "gone") for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6]
    got = [tuple(r) for r in T.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert set(got) == plain(rows) and len(got) == 1


def test_empty_table(spark):
    assert not T.prefix_trie(spark.createDataFrame([], SCHEMA)).collect()


def test_query_equals_a_plain_trie(spark):
    df = spark.read.parquet(f"{DATA}/conversations.parquet")
    got = [tuple(r) for r in T.prefix_trie(df).collect()]
    assert set(got) == plain([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])
