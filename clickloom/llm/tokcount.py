"""Operator 4: token counts by a compiled finite-state tokenizer.

The vocabulary of a byte-level BPE tokenizer becomes a weighted transducer over bytes: a path spells tokens whose
neighbours are allowed (two tokens are neighbours if BPE gives their joined bytes as just these two), and each token
emits 1. It is determinised on demand: a state holds the open token prefixes with the token before each and the count it
lags behind, and a transition carries the number of tokens that it adds (or takes back). A scanner with one character of
lookahead feeds it the pre-tokens, which never join.

A long text is cut into chunks, each a row. A chunk's state map gives for a state before it the state after it and the
tokens that it adds. All states fall together at a certain boundary, so a map is mostly one constant with a short head to
be run from the state before; where a chunk has no such boundary its map is tabulated on the states that can stand before
it. Maps compose associatively, by a parallel prefix scan of Spark joins; a single word of any length stays linear.
"""

from __future__ import annotations

import ast
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch

MAX_STATES = 1 << 18
MAX_MEMO = 400_000
MAX_PAIRS = 1 << 19
CHUNK = 1 << 16
BACK = 1024
LIMIT = 1024

_UNSURE = re.compile(r" (?:\s|\Z)")
_KINDS = ((regex.compile(r"\p{L}"), "l"), (regex.compile(r"\p{N}"), "n"), (regex.compile(r"\p{White_Space}"), "w"))


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(1 << 16)
def kind(c: str) -> str:
    """l: letter, n: number, w: white space, o: any other."""
    return next((k for p, k in _KINDS if p.match(c)), "o")


def pre_tokens(text: str) -> Iterator[str]:
    """Contractions; runs of letters, of numbers or of other signs, with one space before; white space runs."""
    kinds = [kind(c) for c in text]
    i, n = 0, len(text)
    while i < n:
        if text[i] == "'" and (long := 2 if text[i + 1 : i + 2] in ("s", "t", "m", "d") else 3 if text[i + 1 : i + 3] in ("re", "ve", "ll") else 0):
            yield text[i : i + long]
            i += long
            continue
        first = i + (text[i] == " " and i + 1 < n and kinds[i + 1] != "w")
        end = first + 1
        while end < n and kinds[end] == kinds[first]:
            end += 1
        if kinds[first] == "w" and 1 < end - i and end < n:
            end -= 1  # the last one goes with, or stands before, what follows
        yield text[i:end]
        i = end


class Counter:
    """The transducer of one vocabulary file, compiled as far as texts need it."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        named = {t["id"] for t in spec["added_tokens"]}
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[spell(a), spell(b)] = rank
        self.next: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for word, number in spec["model"]["vocab"].items():
            if number in named:
                continue
            node = 0
            for b in (spelled := spell(word)):
                if b not in self.next[node]:
                    self.next[node][b] = len(self.next)
                    self.next.append({})
                    self.token.append(None)
                node = self.next[node][b]
            self.token[node] = spelled
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self._reset()

    def _reset(self) -> None:
        self.items = [((0, b"", 0),)]
        self.names = {self.items[0]: 0}
        self.moves: dict[int, int] = {}

    def merged(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get((parts[i], parts[i + 1]), len(self.ranks)), i) for i in range(len(parts) - 1))
            if rank == len(self.ranks):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, a: bytes, b: bytes) -> bool:
        if not a:
            return True
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return found

    def _name(self, items: tuple) -> int:
        name = self.names.get(items)
        if name is None:
            name = self.names[items] = len(self.items)
            self.items.append(items)
        return name

    def _move(self, state: int, byte: int) -> int:
        """The transition, as the next state times 256 plus 128 plus the tokens it adds."""
        ends, rest = [], []
        for node, last, lag in self.items[state]:
            to = self.next[node].get(byte)
            if to is None:
                continue
            if self.token[to] is not None and self.neighbours(last, self.token[to]):
                ends.append((lag + 1, self.token[to]))
            if self.next[to]:
                rest.append((to, last, lag))
        more, token = min(ends)
        items = tuple(sorted([(0, token, 0), *((n, last, lag - more) for n, last, lag in rest)]))
        move = self.moves[state << 8 | byte] = self._name(items) << 8 | (128 + more)
        return move

    def run(self, data: bytes) -> int:
        if len(self.items) > MAX_STATES:
            self._reset()
        state = total = 0
        moves = self.moves
        for byte in data:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            state = move >> 8
            total += (move & 255) - 128
        return total

    def through(self, state: int, text: str) -> tuple[int, int]:
        total = 0
        for byte in text.encode():
            move = self.moves.get(state << 8 | byte) or self._move(state, byte)
            state = move >> 8
            total += (move & 255) - 128
        return state, total

    def step(self, mode: str, held: str, state: int, c: str) -> tuple[str, str, int, int]:
        """One character of the scanner: its new mode, the white space it holds back, the state, and the tokens added.

        Modes: l, n, o are open runs; w holds back the last white space of a run, whose earlier part is open; a mode with an
        apostrophe may become a contraction; the empty one has nothing open.
        """
        now, n = kind(c), 0
        if mode == "w":
            if now == "w":
                state, n = self.through(state, held)
                return "w", c, state, n
            if held == " ":
                state, n = self.through(0, " " + c)
                return now, "", state, n
            mode, n = "", self.through(0, held)[1]
        elif mode == "'":
            if c in "stmd":
                return "", "", 0, self.through(0, mode + c)[1]
            if c in "rvl":
                return mode + c, "", 0, 0
            mode, (state, n) = "o", self.through(0, "'")
        elif len(mode) == 2:
            if mode + c in ("'re", "'ve", "'ll"):
                return "", "", 0, self.through(0, mode + c)[1]
            state, n = self.through(0, mode[1])
            mode, n = "l", n + self.through(0, "'")[1]
        if mode == now:
            state, more = self.through(state, c)
            return now, "", state, n + more
        if now == "w":
            return "w", c, 0, n
        if c == "'":
            return "'", "", 0, n
        state, more = self.through(0, c)
        return now, "", state, n + more

    def scan(self, start: str, text: str) -> tuple[str, int]:
        """The state after a stretch of text, from the state before it, and the tokens added."""
        if len(self.items) > MAX_STATES:
            self._reset()
        mode, held, items = ast.literal_eval(start)
        state, total = self._name(items), 0
        for c in text:
            mode, held, state, n = self.step(mode, held, state, c)
            total += n
        return repr((mode, held, self.items[state])), total

    def finish(self, at: str) -> int:
        """The tokens that a certain boundary adds: what the scanner held back is closed."""
        mode, held, items = ast.literal_eval(at)
        if mode == "w":
            return self.through(self._name(items), held)[1]
        return sum(self.through(0, c)[1] for c in mode) if mode[:1] == "'" else 0

    def plain(self, text: str) -> int:
        """Tokens of a stretch between certain boundaries."""
        return sum(map(PRE[self.path].__getitem__, pre_tokens(text)))


class _Memo(dict):
    """Counts by string, forgotten when there are too many."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, key: str) -> int:
        if len(self) >= MAX_MEMO:
            self.clear()
        n = self[key] = self.count(key)
        return n


PRE: dict[str, _Memo] = {}
UNITS: dict[str, _Memo] = {}
COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The compiled tokenizer of this worker, kept between batches."""
    if path not in COUNTERS:
        c = COUNTERS[path] = Counter(path)
        PRE[path] = _Memo(lambda s: c.run(s.encode()))
        UNITS[path] = _Memo(lambda s: c.plain(" " + s))
    return COUNTERS[path]


START = repr(("", "", ((0, b"", 0),)))  # a state as text, the same on all workers: what the scanner holds, and the open prefixes
END = "end"


class ChunkMap(NamedTuple):
    """What a chunk does to a state: it reads `head` from it; then, if a certain boundary follows, adds `fixed` and is in `out`."""

    head: str
    fixed: int
    out: str | None


def units(text: str) -> tuple[str, list[str], str] | None:
    """What stands before the first certain boundary, between such boundaries and after the last; None without one.

    A certain boundary stands before each space that a character other than white space follows.
    """
    parts = text.split(" ")
    if _UNSURE.search(text):
        found = parts[:1]
        for p in parts[1:]:
            if p and not p[0].isspace():
                found.append(p)
            else:
                found[-1] += " " + p
        parts = found
    return None if len(parts) == 1 else (parts[0], parts[1:-1], " " + parts[-1])


def _whole(c: Counter, text: str) -> int:
    found = units(text)
    if found is None:
        return c.plain(text)
    return c.plain(found[0]) + sum(map(UNITS[c.path].__getitem__, found[1])) + c.plain(found[2])


def cut(c: Counter, text: str, chunk: int) -> list[str]:
    """Chunks of a text; none ends inside a special token."""
    spans = [m.span() for m in c.split.finditer(text)] if c.split else []
    starts, at = [a for a, _ in spans], [0]
    for i in range(chunk, len(text), chunk):
        k = bisect_left(starts, i) - 1
        to = spans[k][0] if k >= 0 and spans[k][1] > i else i
        if to > at[-1]:
            at.append(to)
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=True)]


def chunk_map(c: Counter, text: str, last: bool) -> ChunkMap:
    """Special tokens and the end of the text are certain boundaries too."""
    parts = c.split.split(text) if c.split else [text]
    fixed, found = len(parts) - 1, units(parts[0])
    head, tail = parts[0], None
    if found is not None:
        head, tail = found[0], found[2]
        fixed += sum(map(UNITS[c.path].__getitem__, found[1]))
    for part in parts[1:]:
        fixed += c.plain(tail) if tail is not None else 0
        tail = part
        if (found := units(part)) is not None:
            fixed += c.plain(found[0]) + sum(map(UNITS[c.path].__getitem__, found[1]))
            tail = found[2]
    if last:
        return ChunkMap(head, fixed + (c.plain(tail) if tail is not None else 0), END)
    if tail is None:
        return ChunkMap(head, 0, None)
    out, n = c.scan(START, tail)
    return ChunkMap(head, fixed + n, out)


def apply_map(c: Counter, m: ChunkMap, into: str) -> tuple[str, int]:
    """The state after the chunk, and the tokens that it adds, from one state before it."""
    out, n = c.scan(into, m.head)
    return (out, n) if m.out is None else (m.out, n + c.finish(out) + m.fixed)


def count_tokens(c: Counter, text: str | None, chunk: int = CHUNK) -> int:
    """Tokens of a text; strings of special tokens are one token each, as the library takes them by default.

    A text of one chunk is the sum over its stretches between certain boundaries; of a longer one the chunks' maps are applied in turn.
    """
    if not text:
        return 0
    if len(text) <= chunk:
        parts = c.split.split(text) if c.split else [text]
        return sum(_whole(c, p) for p in parts if p) + len(parts) - 1
    chunks, at, total = cut(c, text, chunk), START, 0
    for i, part in enumerate(chunks):
        at, n = apply_map(c, chunk_map(c, part, i == len(chunks) - 1), at)
        total += n
    return total


_CHUNK_FIELDS = ("key", "seg", "head", "fixed", "out", "guess")


def _chunk_rows(path: str, chunk: int):  # noqa: ANN202
    """A row a chunk. `guess` is the state that its last BACK characters lead to, for the chunk behind one without certain boundary."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                chunks, before, found = cut(c, text.as_py(), chunk), None, []
                for i, part in enumerate(chunks):
                    m = chunk_map(c, part, i == len(chunks) - 1)
                    found.append((key.as_py(), i, *m, before))
                    before = c.scan(START, part[-BACK:])[0] if m.out is None else None
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds, strict=True)], _CHUNK_FIELDS)

    return rows


def _map_rows(path: str):  # noqa: ANN202
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            cols = [batch.column(x).to_pylist() for x in ("head", "fixed", "out", "into")]
            done = [apply_map(c, ChunkMap(head, fixed, out), into) for head, fixed, out, into in zip(*cols, strict=True)]
            yield pa.record_batch([batch.column("key"), batch.column("seg"), batch.column("into"), pa.array([x for x, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["key", "seg", "into", "out", "n"])

    return rows


def state_maps(chunks: DataFrame, path: str, scratch: Scratch) -> DataFrame:
    """Rows (key, seg, into, out, n): each chunk's map on all states in which the chunk before it can end.

    A chunk behind a certain boundary has one state before it. Behind a chunk without one, the state is guessed by looking
    back; where a map leads elsewhere, the next chunk's map is extended to that state, until no state is missing.
    """
    run = lambda df: scratch.settled(df.select("key", "seg", "head", "fixed", "out", "into").mapInArrow(_map_rows(path), "key string, seg long, into string, out string, n long"))
    before = chunks.select("key", (F.col("seg") + 1).alias("seg"), F.col("out").alias("before"))
    maps = run(chunks.join(before, ["key", "seg"], "left").withColumn("into", F.when(F.col("seg") == 0, F.lit(START)).otherwise(F.coalesce("before", "guess"))))
    while True:
        asked = maps.select("key", (F.col("seg") + 1).alias("seg"), F.col("out").alias("into")).distinct()
        more = run(asked.join(maps.select("key", "seg", "into"), ["key", "seg", "into"], "left_anti").join(chunks, ["key", "seg"]))
        if more.isEmpty():
            return maps
        maps = maps.unionByName(more)


def prefix_scan(maps: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (key, seg, into, out, n): the maps of all chunks of a text up to each chunk, composed in rounds of doubling width."""
    last, width = maps.agg(F.max("seg")).first()[0] or 0, 1
    while width <= last:
        left = maps.select("key", (F.col("seg") + width).alias("seg"), F.col("into").alias("from"), F.col("out").alias("into"), F.col("n").alias("n_before"))
        both = maps.join(left, ["key", "seg", "into"], "left").filter((F.col("seg") < width) | F.col("from").isNotNull())
        maps = scratch.settled(both.select("key", "seg", F.coalesce("from", "into").alias("into"), "out", (F.col("n") + F.coalesce("n_before", F.lit(0))).alias("n")))
        width *= 2
    return maps


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; null and empty texts have none; repeated rows are counted each.

    path: a byte-level BPE file of the tokenizers library, on every executor. Texts of up to `chunk` characters are counted
    where they are. Longer ones become rows of chunks, one set for each different text, whose state maps a parallel prefix scan
    over Spark joins composes; only maps, states and what stands before a chunk's first certain boundary are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            n = [count_tokens(c, t, chunk) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    scratch = Scratch(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    some = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    is_long = F.coalesce(F.char_length("text"), F.lit(0)) > chunk
    short = some.filter(~is_long).mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    long = some.filter(is_long).withColumn("key", F.sha2("text", 256))
    chunks = scratch.settled(long.select("key", "text").mapInArrow(_chunk_rows(path, chunk), "key string, seg long, head string, fixed long, out string, guess string").dropDuplicates(["key", "seg"]))
    if not chunks.isEmpty():
        totals = scratch.settled(prefix_scan(state_maps(chunks, path, scratch), scratch).filter(F.col("out") == END).select("key", F.col("n").alias("n_tokens")))
        short = short.unionByName(long.select("doc_id", "n_bytes", "key").join(totals, "key").drop("key"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
