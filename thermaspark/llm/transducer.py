"""Token counts by a compiled tokenizer: a deterministic transducer whose transitions carry emitted-token counts.

Byte pair encoding is finite-state: a text's encoding is the only one whose neighbouring tokens are all stable (their
joint encoding is themselves), so the last token of every prefix follows from the last tokens of the few shorter
prefixes from which a vocabulary token may still run on. A state holds just that: for each such start the node of the
vocabulary's trie that has been reached, the last token before it and the count there, relative to now. A transition
on a byte moves to the next state and adds to the count. States are built when first met and then kept, at most
MOST_STATES of them (after that the machine starts anew), and all new pieces of a batch run through it in step.

A text is a run of chunks. The map of a chunk over the machine's states is (head, count, tail): between its first and
last safe cut (pieces.safe_cuts) every entry state leads to the same states, so only the count is needed; head and
tail are the bytes whose state depends on neighbours. Maps compose associatively, and long texts are put together
from chunk maps by a scan in pairs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, kept, utf8
from .encode import CALL_BYTES, WORD, byte_values
from .pieces import HashTable, PieceTable, grown, mix, safe_cuts

MOST_STATES, TABLE_BITS, CHUNK = 250_000, 22, 1 << 20
#: Text whose split needs no table of Unicode classes.
LATIN = re.compile("[\x00-\x1b -~À-ÖØ-öø-ÿ]*")
LIMIT = 512
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
START = -1
Map = tuple[bytes, int, bytes] | bytes  # (head, count, tail), or a chunk without a cut


class Machine:
    """The transducer of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = byte_values()
        raw = lambda word: bytes(plain[c] for c in word)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        vocabulary = {raw(w): i for w, i in spec["model"]["vocab"].items() if w not in self.specials}
        self.bytes = {i: w for w, i in vocabulary.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(vocabulary[raw(a)], vocabulary[raw(b)]): (k, vocabulary[raw(a + b)]) for k, (a, b) in enumerate(merges)}
        self.single = [vocabulary[bytes([b])] for b in range(256)]
        self.child: list[dict[int, int]] = [{}]
        self.token = [START]
        for word, i in vocabulary.items():
            node = 0
            for b in word:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(START)
                node = self.child[node][b]
            self.token[node] = i
        self.stable_pairs: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = [((0, START, 0),)]
        self.number = {self.states[0]: 0}
        self.table = HashTable(TABLE_BITS)
        self.next, self.emit = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)

    def encode(self, text: bytes) -> list[int]:
        """Plain merging by rank; for pairs of tokens."""
        ids = [self.single[b] for b in text]
        while len(ids) > 1:
            best = min((self.rank.get(p, (1 << 60, 0)) for p in zip(ids, ids[1:], strict=False)))
            if best[0] == 1 << 60:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.rank.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stable(self, one: int, other: int) -> bool:
        key = (one, other)
        if key not in self.stable_pairs:
            if len(self.stable_pairs) > 2_000_000:
                self.stable_pairs.clear()
            self.stable_pairs[key] = self.encode(self.bytes[one] + self.bytes[other]) == [one, other]
        return self.stable_pairs[key]

    def build(self, state: int, byte: int) -> tuple[int, int]:
        """A new transition: (next state, tokens emitted; negative where a longer token takes back more than one)."""
        last, delta, moved = None, 0, []
        for node, before, count in self.states[state]:  # longest run first
            to = self.child[node].get(byte)
            if to is None:
                continue
            token = self.token[to]
            if last is None and token != START and (before == START or self.stable(before, token)):
                last, delta = token, count + 1
            if self.child[to]:
                moved.append((to, before, count))
        target = (*((node, before, count - delta) for node, before, count in moved), (0, last, 0))
        if target not in self.number:
            self.number[target] = len(self.states)
            self.states.append(target)
        return self.number[target], delta

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state.astype(np.uint64) << np.uint64(8) | byte.astype(np.uint64)
        h = mix(key + np.uint64(1))
        found = self.table.find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            keys, first, inverse = np.unique(h[new], return_index=True, return_inverse=True)
            made = [self.build(int(state[i]), int(byte[i])) for i in new[first].tolist()]
            entry = np.arange(self.table.size, self.table.size + len(keys), dtype=np.int32)
            while len(self.next) < self.table.size + len(keys):
                self.next, self.emit = np.resize(self.next, 2 * len(self.next)), np.resize(self.emit, 2 * len(self.emit))
            self.next[entry], self.emit[entry] = [m[0] for m in made], [m[1] for m in made]
            self.table.add(keys, entry)
            found[new] = entry[inverse]
        return self.next[found], self.emit[found]

    def renewed(self, state: np.ndarray) -> np.ndarray:
        """The machine starts anew with these states alone; their new numbers."""
        used, inverse = np.unique(state, return_inverse=True)
        kept = [self.states[i] for i in used.tolist()]
        self.clear()
        for s in kept:
            if s not in self.number:
                self.number[s] = len(self.states)
                self.states.append(s)
        return np.array([self.number[s] for s in kept], np.int32)[inverse]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word of the split pattern, all run in step."""
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-size, kind="stable")
        raw = np.frombuffer(b"".join(words), np.uint8)
        at = (np.cumsum(size) - size)[order]
        size = size[order]
        state, total = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        for j in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -j, "left"))
            if len(self.states) > MOST_STATES or self.table.size + live > self.table.room:
                state[:live] = self.renewed(state[:live])
            state[:live], emitted = self.step(state[:live], raw[at[:live] + j])
            total[:live] += emitted
        out = np.empty_like(total)
        out[order] = total
        return out


class Counter:
    """Counts of whole texts; remembers the counts of pieces in a bounded table."""

    def __init__(self, path: str):
        self.machine = Machine(path)
        from tokenizers import Tokenizer

        self.split = regex.compile(public_tokenizers.PATTERN)
        self.library_split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = re.compile("|".join(map(re.escape, sorted(self.machine.specials, key=len, reverse=True))) or "(?!)")
        self.special_bytes = [s.encode() for s in self.machine.specials]
        self.counts = np.empty(0, np.int32)
        self.table = PieceTable(TABLE_BITS, self.learn)

    def learn(self, pieces: list[bytes], entries: np.ndarray) -> None:
        self.counts = grown(self.counts, int(entries[-1]) + 1)
        self.counts[entries] = self.of_pieces(pieces)

    def of_pieces(self, pieces: list[bytes]) -> np.ndarray:
        words, owner = [], []
        for i, piece in enumerate(pieces):
            text = piece.decode()
            if WORD.fullmatch(text):
                words.append(piece)
                owner.append(i)
            else:
                # for other scripts the library's own classes of characters decide
                parts = self.split.findall(text) if LATIN.fullmatch(text) else [text[a:b] for _, (a, b) in self.library_split(text)]
                words += [p.encode() for p in parts]
                owner += [i] * len(parts)
        return np.bincount(np.array(owner, np.int64), self.machine.count(words), len(pieces)).astype(np.int32) if words else np.zeros(len(pieces), np.int32)

    def entries(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Counts of the pieces raw[start:end]."""
        found = self.table.entries(raw, starts, ends)
        return self.counts[found]

    # -- chunk maps -------------------------------------------------------

    def chunk_map(self, chunk: bytes) -> Map:
        raw = np.frombuffer(chunk, np.uint8)
        cuts = safe_cuts(raw, np.array([0, len(raw)]))[1:]
        if not len(cuts):
            return chunk
        inner = self.entries(raw, cuts[:-1], cuts[1:]).sum() if len(cuts) > 1 else 0
        return chunk[: cuts[0]], int(inner), chunk[cuts[-1] :]

    def compose(self, one: Map, other: Map) -> Map:
        if isinstance(one, bytes):
            return one + other if isinstance(other, bytes) else (one + other[0], other[1], other[2])
        if isinstance(other, bytes):
            return one[0], one[1], one[2] + other
        return one[0], one[1] + self.plain(one[2] + other[0]) + other[1], other[2]

    def plain(self, text: bytes) -> int:
        return int(self.of_pieces([text])[0]) if text else 0

    def scan(self, maps: list[Map]) -> int:
        """The count of a text from its chunks' maps, composed in pairs."""
        while len(maps) > 1:
            maps = [self.compose(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        m = maps[0] if maps else b""
        return self.plain(m) if isinstance(m, bytes) else self.plain(m[0]) + m[1] + self.plain(m[2])

    def long_text(self, text: bytes) -> int:
        if any(s in text for s in self.special_bytes):
            parts = self.special.split(text.decode())
            return sum(self.long_text(p.encode()) for p in parts) + len(parts) - 1
        return self.scan([self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)])

    def count(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(offsets) - 1, np.int64)
        data = raw.tobytes()
        special = any(s in data for s in self.special_bytes)
        i, n = 0, len(out)
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CALL_BYTES, "right")) - 1)
            if special or offsets[j] - offsets[i] > CALL_BYTES:
                for k in range(i, j):
                    out[k] = self.long_text(data[offsets[k] : offsets[k + 1]])
            elif offsets[j] > offsets[i]:
                part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts = safe_cuts(part, at)
                sums = np.append(0, np.cumsum(self.entries(part, starts, np.append(starts[1:], len(part))), dtype=np.int64))
                out[i:j] = np.diff(sums[np.searchsorted(starts, at, "left")])
            i = j
        return out


def counter(path: str) -> Counter:
    """One per worker process and file, until a task of another operator comes."""
    return kept(Counter, path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document.

    Defined results: a null text is empty and has no tokens; a special string inside a text is one token, as the
    library takes it; repeated rows come back each; an empty table gives no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = utf8(b.column(1))
            n = counter(tokenizer).count(raw, offsets)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
