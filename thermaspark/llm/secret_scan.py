"""Secret scans by a trigram inverted index, in DataFrame operations only.

From each rule's regular expression a Boolean query over trigrams is derived on the driver (required_trigrams). The
index holds, for every trigram of these queries, the rows whose lower-cased text has it. Intersecting the postings of
a row leaves the rules whose query holds, and only those are verified on its text. A rule without a mandatory trigram
is verified on every text.

Defined results: a null text is empty and has no spans; repeated rows come back each; a null doc_id is kept; of spans
that start together the rule listed first comes first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded

try:
    from re import _constants as sre, _parser as sre_parser
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse as sre_parser


@dataclass(frozen=True)
class Rule:
    """least characters are asked of `group`. scan: an expression with the same matches of at least that length, if that is cheaper."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False
    scan: str | None = None


RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]+", 0, 32, True, r"[0-9a-f]{32,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----([A-Za-z0-9+/=\r\n]*-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
#: Candidates, of 16 bytes each, that may be broadcast; more meet the texts in a shuffle.
MOST_BROADCAST = 1_000_000
#: Sets of exact strings larger than this are given up for a weaker query.
MOST_STRINGS = 24

Query = tuple | None  # None: no condition; ("tri", t), ("and", parts), ("or", parts)


def _all(parts: list[Query]) -> Query:
    parts = [p for p in parts if p is not None]
    return parts[0] if len(parts) == 1 else ("and", tuple(parts)) if parts else None


def _any(parts: list[Query]) -> Query:
    return None if any(p is None for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]) -> Query:
    return _any([_all([("tri", s[i : i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)])


def required_trigrams(pattern: str) -> Query:
    """What the lower-cased text of any match holds: literals run together, alternatives are joined by or."""

    def strings(nodes) -> set[str] | None:
        """All strings that the nodes match, if they are few."""
        run, queries = walk(nodes)
        return run if not queries and run is not None else None

    def walk(nodes) -> tuple[set[str] | None, list[Query]]:
        run: set[str] = {""}
        queries: list[Query] = []
        exact = True

        def flush() -> None:
            nonlocal run, exact
            queries.append(_of_strings(run))
            run, exact = {""}, False

        for op, value in nodes:
            more: set[str] | None = None
            if op is sre.LITERAL:
                more = {chr(value).lower()}
            elif op is sre.IN and all(k is sre.LITERAL for k, _ in value):
                more = {chr(v).lower() for _, v in value}
            elif op is sre.SUBPATTERN:
                more = strings(value[-1])
                if more is None:
                    flush()
                    inner, own = walk(value[-1])
                    queries.append(_all([*own, _of_strings(inner or {""})]))
                    continue
            elif op is sre.BRANCH:
                found = [strings(b) for b in value[1]]
                if all(f is not None for f in found):
                    more = set().union(*found)
                else:
                    flush()
                    queries.append(_any([_all([*(w := walk(b))[1], _of_strings(w[0] or {""})]) for b in value[1]]))
                    continue
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, inner = value
                own = strings(inner)
                if own is not None and high == 1:
                    more = own | {""}
                elif own is not None and low == high and low <= 8:
                    more = {""}
                    for _ in range(low):
                        more = {a + b for a in more for b in own} if len(more) * len(own) <= MOST_STRINGS else None
                        if more is None:
                            break
                elif low:
                    flush()
                    w = walk(inner)
                    queries.append(_all([*w[1], _of_strings(w[0] or {""})]))
                    continue
            elif op is sre.AT:
                continue
            if more is None or len(run) * len(more) > MOST_STRINGS:
                flush()
                if more is not None and len(more) <= MOST_STRINGS:
                    run = more
            else:
                run = {a + b for a in run for b in more}
        if not exact:
            flush()
            return {""}, [q for q in queries if q is not None]
        return run, []

    run, queries = walk(sre_parser.parse(pattern))
    return _all([*queries, _of_strings(run or {""})])


def trigrams(query: Query) -> set[str]:
    return set() if query is None else {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1]))


def holds(query: Query, has: dict[str, Column]) -> Column:
    """The query as a Boolean column over a row's intersected postings."""
    if query is None:
        return F.lit(True)
    if query[0] == "tri":
        return has[query[1]]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, [holds(q, has) for q in query[1]])


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    return own.withColumn("key", F.xxhash64("doc_id", "text"))


def index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, key) of the trigrams that any rule asks for."""
    # lower-cased once, as a column of its own, for all trigrams
    low = docs.select("key", F.lower("text").alias("low")).filter("low is not null")
    found = F.array(*(F.when(F.contains(F.col("low"), F.lit(t)), F.lit(i)) for i, t in enumerate(wanted)))
    return low.select("key", F.explode(found).alias("trigram")).filter("trigram is not null")


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules: bit i is set if rule i's query holds), for rows where any query with a trigram holds."""
    queries = [required_trigrams(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams, queries)))
    words = -(-len(wanted) // 63)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("trigram") % 63).cast("int"))
    met = index(docs, wanted).groupBy("key").agg(*(F.bit_or(F.when(F.floor(F.col("trigram") / 63) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"has{w}") for w in range(words)))
    has = {t: F.col(f"has{i // 63}").bitwiseAND(F.lit(1 << (i % 63)).cast("long")) != 0 for i, t in enumerate(wanted)}
    bits = [F.when(holds(q, has), F.lit(1 << i)).otherwise(F.lit(0)) for i, q in enumerate(queries) if q is not None]
    return met.select("key", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("rules")).filter("rules != 0")


def opened(found: Column, rules: tuple[Rule, ...]) -> Column:
    always = sum(1 << i for i, r in enumerate(rules) if required_trigrams(r.pattern) is None)
    return F.coalesce(found, F.lit(0)).bitwiseOR(F.lit(always))


def with_candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """keyed() rows with `open`, the rules to verify: those whose query holds and those without a query."""
    return docs.join(bounded(candidates(docs, rules), MOST_BROADCAST), "key", "left").withColumn("open", opened(F.col("rules"), rules))


def cell_of(nth: int, least: int):
    def cell(x: Column, at: Column) -> Column:
        ok = F.char_length(x["p"]) >= least
        return F.struct(F.lit(nth).alias("nth"), at.cast("int").alias("at"), F.char_length(x["g"]).alias("gap"), F.char_length(x["w"]).alias("size"), ok.alias("ok"))

    return cell


def matches(text: Column, open_rules: Column, rules: tuple[Rule, ...]) -> list[Column]:
    """For each rule the cells of all its matches in a text."""
    none = F.array().cast("array<struct<nth:int,at:int,gap:int,size:int,ok:boolean>>")
    found = []
    for i, r in enumerate(rules):
        p = F.lit(r.scan or r.pattern)
        whole, part = F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(r.group))
        gaps = F.split(text, r.scan or r.pattern, -1)
        zipped = F.arrays_zip(whole.alias("w"), part.alias("p"), F.slice(gaps, F.lit(1), F.size(whole)).alias("g"))
        cells = F.transform(zipped, cell_of(i, r.least))
        is_open = open_rules.bitwiseAND(F.lit(1 << i)) != 0
        found.append(F.when(is_open & F.regexp_like(text, p), cells).otherwise(none))
    return found


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document and span, or one with null kind where there is none: row, doc_id, kind, nth, start, end (code points)."""
    rows = with_candidates(keyed(docs), rules)
    found = F.concat(*matches(F.col("text"), F.col("open"), rules))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("found"))
    cells = numbered.select("row", "doc_id", F.explode_outer("found").alias("c")).select("row", "doc_id", "c.*")
    run = Window.partitionBy("row", "nth").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(run)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return cells.select("row", "doc_id", F.get(kinds, F.col("nth")).alias("kind"), "nth", (end - F.col("size")).alias("start"), end.alias("end"), F.coalesce("ok", F.lit(False)).alias("ok"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<base kind>, base_sha256, spans."""
    spans = find(docs, rules)
    span = F.struct("start", "nth", F.concat_ws(":", "kind", "start", "end").alias("name"))
    base = [i for i, r in enumerate(rules) if r.base]
    got = spans.groupBy("row", "doc_id").agg(
        *(F.count(F.when(F.col("ok") & (F.col("nth") == i), 1)).alias(f"n_{rules[i].kind}") for i in base),
        F.sort_array(F.collect_list(F.when(F.col("ok"), span))).alias("all"),
    )
    names = lambda a: F.array_join(F.transform(a, lambda x: x["name"]), ",")
    own = F.filter("all", lambda x: x["nth"].isin(base))
    return got.select("doc_id", *(f"n_{rules[i].kind}" for i in base), F.sha2(names(own), 256).alias("base_sha256"), names(F.col("all")).alias("spans"))


def without_spans(text: Column, cells: list[Column], mark: str) -> Column:
    """The text with each of the spans that scan() reports, or run of overlapping ones, replaced by the mark."""
    kind = "struct<at:int,spans:array<struct<start:int,end:int>>>"
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans")).cast(kind)

    spans = F.array_sort(F.concat(*(F.aggregate(c, none.cast(kind), step, lambda acc: acc["spans"]) for c in cells)))

    def cut(acc: Column, x: Column) -> Column:
        apart = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        out = F.when(x["start"] >= acc["at"], apart).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], x["end"]).alias("at")).cast("struct<out:string,at:int>")

    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at")).cast("struct<out:string,at:int>")
    changed = F.aggregate(spans, first, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, changed).otherwise(text)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret that scan() finds in `text` replaced and n_chars counted again; other columns as they are. A null text stays null."""
    found = bounded(candidates(keyed(docs), rules), MOST_BROADCAST)
    text = F.col("d.text").cast("string")
    named = docs.alias("d").join(found.alias("c"), F.xxhash64(F.col("d.doc_id").cast("long"), F.coalesce(text, F.lit(""))) == F.col("c.key"), "left")
    clean = without_spans(text, matches(text, opened(F.col("c.rules"), rules), rules), mark)
    out = named.select(*(F.when(F.col("d.text").isNotNull(), clean).alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result in DuckDB."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(rules):
        p = quoted(r.scan or r.pattern)
        parts.append(f"SELECT doc_id, '{r.kind}' AS kind, {i} AS nth, {r.least} AS least, {str(r.base).lower()} AS base, string_split_regex(t, {p}) AS g, regexp_extract_all(t, {p}, 0) AS w, regexp_extract_all(t, {p}, {r.group}) AS p FROM d")
    n = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules if r.base)
    outer = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules if r.base)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (SELECT doc_id, kind, nth, least, base, g, w, p, unnest(range(1, len(w) + 1)) AS i FROM m WHERE len(w) > 0),
s AS (SELECT doc_id, kind, nth, base, CAST(length(array_to_string(g[1:i], '')) + length(array_to_string(w[1:i-1], '')) AS BIGINT) AS st, length(w[i]) AS n
 FROM e WHERE length(p[i]) >= least),
a AS (SELECT doc_id, {n}, string_agg(CASE WHEN base THEN kind || ':' || st || ':' || (st + n) END, ',' ORDER BY st, nth) AS b, string_agg(kind || ':' || st || ':' || (st + n), ',' ORDER BY st, nth) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, {outer}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""
