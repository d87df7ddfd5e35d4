"""Phrases whose words keep together: counts by multikey quicksort of suffix pointers, scores by exact division.

Every word starts a suffix: itself and the two words that follow it in its piece of text. Suffixes are routed by their
leading word, those of frequent leading words by the first two or all three words, so that no route holds one word's
share of a corpus; equal suffixes of a stretch of text travel once, with their number. In a route a three-way partition
by the word at the current depth, applied to all live segments at once, sorts pointers to suffixes; what equals the
pivot is a phrase, its size the phrase's count, and goes on one word deeper. Segments that are too small for any
frequent phrase are abandoned. Counts of leading words that are split over routes are added up afterwards.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, lean, staged

DEPTH, LEAST, TOP, SHARE = 3, 10, 2000, 50
#: Bytes of text that a task holds and that it counts at once (words of a stretch fit into 21 bits).
HOLD, STRETCH = 16 << 20, 2 << 20
#: Words whose suffixes one route takes, and most routes; a leading phrase of an eighth of a route's words is split.
ROUTE_WORDS, MOST_ROUTES = 2_000_000, 200_000
#: A leading phrase is noticed in stretches that hold it so often. This only decides how evenly routes are filled.
NOTICED = 16
#: A-Z to a-z, tabs to spaces, what ends a piece to line feeds.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
WORD = re.compile(rb"[ \n]*[^ \n]+")
GAP = re.compile(rb"[ \n]")


class Stretch:
    """Words of folded text: `words` by number from 1, and for each word that starts in it the numbers of it and the next two (0: beyond its piece)."""

    def __init__(self, text: bytes, own: int):
        raw = np.frombuffer(text, np.uint8)
        solid = (raw != 32) & (raw != 10)
        starts = np.flatnonzero(solid & ~np.append(False, solid[:-1]))
        piece = np.cumsum(raw == 10, dtype=np.int32)[starts]
        number: dict[bytes, int] = defaultdict(count(1).__next__)
        ids = np.fromiter(map(number.__getitem__, text.split()), np.int64, len(starts))
        self.words, self.number, self.n = list(number), number, int(np.searchsorted(starts, own))
        self.next = [ids[: self.n]]
        for k in range(1, DEPTH):
            there = np.zeros(self.n, np.int64)
            m = min(self.n, max(0, len(ids) - k))
            there[:m] = np.where(piece[k : k + m] == piece[:m], ids[k : k + m], 0)
            self.next.append(there)

    def pairs(self) -> np.ndarray:
        return self.next[0] * (len(self.words) + 1) + self.next[1]


def stretches(text: bytes, size: int = STRETCH) -> Iterator[Stretch]:
    """Of a folded text, cut between words; a stretch sees the two words behind it."""
    start = 0
    while start < len(text):
        gap = GAP.search(text, start + size) if len(text) - start > size else None
        end = gap.start() if gap else len(text)
        far = end
        for _ in range(DEPTH - 1):
            m = WORD.match(text, far)
            far = m.end() if m else far
        yield Stretch(text[start:far], end - start)
        start = end


def by_lang(batches: Iterator[pa.RecordBatch], hold: int = HOLD) -> Iterator[tuple[str, Stretch]]:
    """Stretches of all texts of a task, those of a language together."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def settle() -> Iterator[tuple[str, Stretch]]:
        for lang, texts in held.items():
            for s in stretches(b"\n".join(texts)):
                if s.n:
                    yield lang, s
        held.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text.encode().translate(FOLD))
            size += len(held[lang][-1])
            if size >= hold:
                yield from settle()
                size = 0
    yield from settle()


def texts_of(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).filter("text != ''")


def leads(docs: DataFrame) -> DataFrame:
    """lang, lead, n: words of a language in all (lead null), and how often leading words and pairs were noticed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, s in by_lang(batches):
            out = [(None, s.n)]
            often = np.bincount(s.next[0], minlength=len(s.words) + 1)
            out += [(s.words[i - 1].decode(), int(often[i])) for i in np.flatnonzero(often >= NOTICED).tolist()]
            pairs, n = np.unique(s.pairs()[(often[s.next[0]] >= NOTICED) & (s.next[1] > 0)], return_counts=True)
            for pair, k in zip(pairs[n >= NOTICED].tolist(), n[n >= NOTICED].tolist(), strict=True):
                a, b = divmod(pair, len(s.words) + 1)
                out.append(((s.words[a - 1] + b" " + s.words[b - 1]).decode(), k))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out), pa.string()), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.int64())], names=["lang", "lead", "n"])

    return texts_of(docs).mapInArrow(lean(run), "lang string, lead string, n long").groupBy("lang", "lead").agg(F.sum("n").alias("n"))


class Heavy:
    """Leading words and pairs whose suffixes are dealt over several routes."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.words: dict[str, dict[bytes, list[bytes]]] = {}
        for lang, lead in rows:
            head, _, rest = lead.encode().partition(b" ")
            seconds = self.words.setdefault(lang, {}).setdefault(head, [])
            if rest:
                seconds.append(rest)

    def of(self, lang: str, number: dict[bytes, int], n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word of a numbering is heavy, and the heavy pairs of them as word * (n_words + 1) + word, ascending."""
        heavy, pairs = np.zeros(n_words + 1, bool), []
        own = self.words.get(lang, {})
        for word in own.keys() & number.keys() if own else ():
            heavy[number[word]] = True
            pairs += [number[word] * (n_words + 1) + number[x] for x in own[word] if x in number]
        return heavy, np.sort(np.array(pairs, np.int64))


def is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values if len(among) else np.zeros(len(values), bool)


def routed(docs: DataFrame, heavy: Heavy, routes: int) -> DataFrame:
    """route, lang, words (space-joined), suffixes (four 32-bit numbers each: three words from 1 or 0, and how often)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, s in by_lang(batches):
            base = len(s.words) + 1
            keys, n = np.unique(s.pairs() * base + s.next[2], return_counts=True)
            pair, third = np.divmod(keys, base)
            first, second = np.divmod(pair, base)
            seed = zlib.crc32(lang.encode())
            crc = np.array([0, *(zlib.crc32(w, seed) for w in s.words)], np.uint64)
            is_heavy, heavy_pairs = heavy.of(lang, s.number, base - 1)
            with np.errstate(over="ignore"):
                at = crc[first]
                at = np.where(is_heavy[first], at * np.uint64(0x9E3779B1) + crc[second], at)
                at = np.where(is_in(pair, heavy_pairs), at * np.uint64(0x9E3779B1) + crc[third], at)
                at = (at ^ (at >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            route = ((at >> np.uint64(33)) % np.uint64(routes)).astype(np.int64)
            order = np.argsort(route, kind="stable")
            table, ends = np.stack([first, second, third, n], 1)[order], np.flatnonzero(np.append(np.diff(route[order]), 1)) + 1
            out: list[tuple[int, bytes, bytes]] = []
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                part = table[a:b]
                used, own = np.unique(part[:, :DEPTH], return_inverse=True)
                own = own.reshape(-1, DEPTH) + (used[0] != 0)
                used = used[used > 0]
                suffixes = np.concatenate([own, part[:, DEPTH:]], 1).astype("<i4").tobytes()
                out.append((int(route[order[a]]), b" ".join([s.words[i - 1] for i in used.tolist()]), suffixes))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([lang] * len(out), pa.string()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], names=["route", "lang", "words", "suffixes"])

    return texts_of(docs).mapInArrow(lean(run), "route int, lang string, words binary, suffixes binary")


def equal_partitions(suffixes: np.ndarray, times: np.ndarray, least: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, a suffix of each, count) of the phrases at the head of suffixes (rows of word numbers, 0 beyond the end).

    Multikey quicksort of pointers to the suffixes, three-way, all live segments a step at a time. A segment whose
    suffixes occur fewer than least[depth] times holds no phrase of more words that occurs so often, and is left.
    """
    pointer = np.arange(len(suffixes))
    starts, depth = np.zeros(1 if len(suffixes) else 0, np.int64), np.zeros(1 if len(suffixes) else 0, np.int64)
    floor = np.array(least)
    while len(starts):
        sizes = np.diff(np.append(starts, len(pointer)))
        segment = np.repeat(np.arange(len(starts)), sizes)
        word = suffixes[pointer, depth[segment]]
        a, b, c = word[starts], word[starts + sizes // 2], word[starts + sizes - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        side = np.sign(word - pivot[segment]).astype(np.int64) + 1
        part = 3 * segment + side
        total = np.bincount(part, times[pointer], 3 * len(starts)).astype(np.int64)
        number = np.bincount(part, minlength=3 * len(starts))
        deep = np.repeat(depth, 3)
        keep = (number > 0) & (total >= floor[deep])
        middle = np.arange(1, len(keep), 3)
        keep[middle] &= pivot > 0
        found = np.flatnonzero(keep[middle])
        placed = np.cumsum(np.where(keep, number, 0)) - np.where(keep, number, 0)
        moved = np.zeros(int(np.where(keep, number, 0).sum()), np.int64)
        for k in range(3):
            own = np.flatnonzero((side == k) & keep[part])
            mine = np.where(keep[k::3], number[k::3], 0)
            shift = placed[k::3] - (np.cumsum(mine) - mine)
            moved[shift[segment[own]] + np.arange(len(own))] = pointer[own]
        for d in np.unique(depth[found]).tolist():
            of = found[depth[found] == d]
            yield d + 1, moved[placed[3 * of + 1]], total[3 * of + 1]
        deep[middle] += 1
        live = keep & (deep < suffixes.shape[1])
        inside = np.repeat(live[keep], number[keep])
        pointer = moved[inside]
        starts, depth = (np.cumsum(number[live]) - number[live]), deep[live]


def counted(parts: DataFrame, heavy: Heavy, least: int) -> DataFrame:
    """lang, phrase, size, f of a route's phrases of one to three words; those at split leading words are shares of their counts."""

    def of_route(rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"lang": [], "phrase": [], "size": [], "f": []}
        langs = np.array(rows.column("lang").to_pylist(), object)
        for lang in sorted(set(langs.tolist())):
            number: dict[bytes, int] = defaultdict(count(1).__next__)
            tables = []
            for i in np.flatnonzero(langs == lang).tolist():
                own = rows.column("words")[i].as_py().split(b" ")
                to = np.array([0, *map(number.__getitem__, own)], np.int32)
                table = np.frombuffer(rows.column("suffixes")[i].as_py(), "<i4").reshape(-1, DEPTH + 1)
                tables.append(np.concatenate([to[table[:, :DEPTH]], table[:, DEPTH:]], 1))
            every, words = np.concatenate(tables), list(number)
            is_heavy, pairs = heavy.of(lang, number, len(words))
            one = is_heavy[every[:, 0]]
            two = is_in(every[:, 0].astype(np.int64) * (len(words) + 1) + every[:, 1], pairs)
            for rows_of, floor in ((~one, (least,) * 3), (one & ~two, (1, least, least)), (two, (1, 1, least))):
                suffixes, times = every[rows_of, :DEPTH], every[rows_of, DEPTH]
                for size, at, f in equal_partitions(suffixes, times, floor):
                    out["lang"] += [lang] * len(at)
                    out["phrase"] += [b" ".join([words[w - 1] for w in x]).decode() for x in suffixes[at, :size].tolist()]
                    out["size"] += [size] * len(at)
                    out["f"] += f.tolist()
        return pa.table([pa.array(out["lang"], pa.string()), pa.array(out["phrase"], pa.string()), pa.array(out["size"], pa.int32()), pa.array(out["f"], pa.int64())], names=list(out))

    return parts.groupBy("route").applyInArrow(of_route, "lang string, phrase string, size int, f long")


def phrases(docs: DataFrame, least: int = LEAST, route_words: int = ROUTE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of every phrase of one to three words that occurs `least` times, and (lang, n) with the words of each language."""
    spark = docs.sparkSession
    seen = staged(leads(docs), "leads")
    words = seen.filter("lead IS NULL").select("lang", "n")
    n = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = max(route_words, -(-n // MOST_ROUTES))
    routes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // own))
    # at most 16 words and pairs a route: each holds an eighth of a route's words
    heavy = Heavy([(r["lang"], r["lead"]) for r in seen.filter(F.col("lead").isNotNull() & (F.col("n") >= max(1, own // 8))).collect()])
    found = counted(routed(docs, heavy, routes), heavy, least)
    whole = found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return staged(whole, "phrases"), words


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, route_words: int = ROUTE_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases of two and three words.

    Defined results: a null lang is `und`, a null text empty; empty texts have no words; repeated rows count each; a text
    of any length counts whole; languages without frequent phrases and empty tables give no rows; other columns are ignored.
    """
    every, words = phrases(docs, least, route_words)
    candidates = every.filter("size > 1").withColumn("w", F.split("phrase", " ")).withColumnRenamed("f", "a")
    cut = lambda k, first, rest: F.struct(F.lit(k).alias("k"), first.alias("first"), rest.alias("rest"))
    w = [F.get("w", F.lit(i)) for i in range(DEPTH)]
    pair = lambda i: F.concat_ws(" ", w[i], w[i + 1])
    cuts = F.when(F.col("size") == 2, F.array(cut(1, w[0], w[1]))).otherwise(F.array(cut(1, w[0], pair(1)), cut(2, pair(0), w[2])))
    at = candidates.select("lang", "phrase", "size", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "size", "a", "c.*")
    side = lambda name, n: every.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    score = F.expr("CAST(1000000 * CAST(a AS DECIMAL(16,0)) AS DECIMAL(22,0)) * CAST(a AS DECIMAL(16,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    scored = at.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    triples = candidates.filter("size = 3").select("lang", "a", F.explode(F.array(pair(0), pair(1))).alias("phrase"))
    longer = triples.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(f"longer IS NULL OR size > 2 OR 100 * longer < {SHARE} * a")
    kept = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    dealt = kept.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (SELECT COALESCE(lang, 'und') AS lang, ROW_NUMBER() OVER () AS doc, regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, doc, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, w[i] AS w1, w[i+1] AS w2, w[i+2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w)+1)) AS i FROM p)),
f AS (SELECT lang, w1 AS phrase, 1 AS size, COUNT(*) AS f FROM g GROUP BY ALL
 UNION ALL SELECT lang, w1 || ' ' || w2, 2, COUNT(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
 UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, COUNT(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY 1),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k+1:], ' ') AS rest FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (SELECT k.lang, k.phrase, k.size, a, k, x.f AS l, y.f AS r, CAST((1000000::HUGEINT*a*a) // (x.f::HUGEINT*y.f) AS BIGINT) AS score FROM k JOIN f x ON x.lang=k.lang AND x.phrase=head AND x.size=k JOIN f y ON y.lang=k.lang AND y.phrase=rest AND y.size=k.size-k),
b AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE size = 3),
e AS (SELECT * FROM b WHERE size > 2 OR NOT EXISTS (SELECT 1 FROM t WHERE t.lang=b.lang AND t.phrase=b.phrase AND 100*t.a >= 50*b.a)),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
