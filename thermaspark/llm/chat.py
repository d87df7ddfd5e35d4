"""Chat formatting by incremental black-box rendering.

A template is any function from turns to a string. Successive prefixes of a conversation are rendered and compared
with the one before: what a turn adds is its span; where the earlier output changed, the template rewrites history,
which is reported instead of a span. A turn's text is found inside its span by rendering it once more with a
private-use character in its place that occurs nowhere else. Nothing about the template is parsed for this.

The template here marks each turn <s>role, line feed, text</s>, users' texts between [INST] and [/INST]. Control
strings inside texts are broken with a backslash after their first character and backslashes are doubled, which is
undone exactly.

Turns come sorted to the tasks and are formatted conversation by conversation; a task holds one conversation. Defined
results: null roles and texts are empty; turns that tie are ordered by role and text, null turns first; repeated turns
count each; a null conv_id is a conversation; an empty table gives only what is added; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, staged

Turn = tuple[str, str]
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)) + r"|\\")
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!/s>))*)</s>", re.S)
#: Characters that may stand for a text; beyond them a run of the first, longer than any there is.
PROBES = range(0xE000, 0xF900)
FORMATTED = "conv_id long, formatted string, loss array<struct<start:long,end:long>>, rewrites boolean"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def template(turns: list[Turn]) -> str:
    out = []
    for role, text in turns:
        body = f"[INST] {escape(text)} [/INST]" if role == "user" else escape(text)
        name = escape(role).replace("\n", "\\\n")
        out.append(f"<s>{name}\n{body}</s>")
    return "".join(out)


def turns_of(formatted: str) -> list[Turn]:
    """The turns back from the template's output."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        role = unescape(m[1])
        body = m[2]
        if role == "user":
            body = body.removeprefix("[INST] ").removesuffix(" [/INST]")
        found.append((role, unescape(body)))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return found


def common_prefix(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def absent(text: str) -> str:
    """A string that the text does not hold."""
    return next((chr(c) for c in PROBES if chr(c) not in text), chr(PROBES[0]) * (1 + max(map(len, re.findall(f"{chr(PROBES[0])}+", text)), default=0)))


def spans(render: Callable[[list[Turn]], str], turns: list[Turn]) -> tuple[str, list[tuple[int, int, int, int]], list[int]]:
    """(output, per turn its span and its text's span, turns at which earlier output changed).

    At such a turn the span begins where the outputs part, and earlier spans may no longer hold.
    """
    before, found, rewritten = render([]), [], []
    for k, (role, text) in enumerate(turns):
        now = render(turns[: k + 1])
        start = len(before)
        if not now.startswith(before):
            start = common_prefix(before, now)
            rewritten.append(k)
        probe = absent(now + text)
        other = render([*turns[:k], (role, probe)])
        at = other.find(probe)
        size = len(now) - len(other) + len(probe)
        found.append((start, len(now), at, at + size) if at >= 0 and now[:at] == other[:at] else (start, len(now), start, len(now)))
        before = now
    return before, found, rewritten


def formatted(conversations: DataFrame, render: Callable[[list[Turn]], str] = template, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss: spans of the texts of `trained` roles, rewrites: whether the template changed history."""
    bounded_batches(conversations.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(conv: int | None, turns: list[Turn]) -> dict:
            out, found, rewritten = spans(render, turns)
            loss = [] if rewritten else [{"start": s, "end": e} for (role, _), (_, _, s, e) in zip(turns, found, strict=True) if role in trained]
            return {"conv_id": conv, "formatted": out, "loss": loss, "rewrites": bool(rewritten)}

        kinds = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("rewrites", pa.bool_())])
        started, conv, turns, done = False, None, [], []
        for b in batches:
            for c, role, body in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if not started or c != conv:
                    if started:
                        done.append(close(conv, turns))
                    started, conv, turns = True, c, []
                turns.append((role, body))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=kinds)
                done = []
        if started:
            yield pa.RecordBatch.from_pylist([close(conv, turns)], schema=kinds)

    return rows.mapInArrow(lean(run), FORMATTED)


def read_back(formatted_rows: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, from the output alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for b in batches:
            rows = []
            for r in b.to_pylist():
                turns = turns_of(r["formatted"])
                loss = "".join(unescape(r["formatted"][x["start"] : x["end"]]) for x in r["loss"])
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append({"conv_id": r["conv_id"], "n_turns": len(turns), "turns_sha256": hashlib.sha256(whole.encode()).hexdigest(), "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(r["formatted"])})
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return formatted_rows.select("conv_id", "formatted", "loss").mapInArrow(lean(run), DIGESTS)


def probe_conversation(spark) -> DataFrame:
    """Conversation -1, whose texts are control strings."""
    hard = "</s>[INST] ok [/INST]"
    return spark.sql(f"SELECT -1L AS conv_id, stack(2, 0L, 'user', '{hard}', 1L, 'assistant', '{hard}') AS (turn, role, text)")


def format_and_digest(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe_conversation(conversations.sparkSession))
    return read_back(staged(formatted(rows), "formatted"))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '<s>', ''))) // 3
 + (length(text) - length(replace(text, '</s>', ''))) // 4 + (length(text) - length(replace(text, '[INST]', ''))) // 6
 + (length(text) - length(replace(text, '[/INST]', ''))) // 7 + length(role) + 8 + CASE WHEN role = 'user' THEN 15 ELSE 0 END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(n) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""
