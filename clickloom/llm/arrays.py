"""Small numpy helpers shared by the text operators: word bounds and 64-bit hashes of whole Arrow batches."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SPACE = 32
SLICE_BYTES = (1 << 20) - (1 << 14)
HASHED = (1 << 19) - 1  # bytes that are hashed at a time, which bounds the tables of powers

# Bytes 0x09-0x0D and 0x20 separate words; A-Z become a-z in the lowering table.
KEEP = np.arange(256, dtype=np.uint8)
KEEP[9:14] = SPACE
LOWER = KEEP.copy()
LOWER[65:91] += 32

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

LARGE = 4 << 20  # bytes of a group after which its worker frees memory


def free_memory() -> None:
    """What this worker holds but no longer uses goes back to the system; Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """A function of batches for mapInArrow that frees its worker's memory at the end, as workers outlive stages."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            free_memory()

    return run


def lean_bucket(work: Callable) -> Callable:
    """The same for a function of a group's key and batches, for applyInArrow."""

    @functools.wraps(work)
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(key, batches)
        finally:
            free_memory()

    return run


def lean_group(work: Callable) -> Callable:
    """A function of a group's table for applyInArrow that frees its worker's memory after a large group."""

    @functools.wraps(work)
    def run(table: pa.Table) -> pa.Table:
        size = table.nbytes
        out = work(table)
        if size > LARGE:
            free_memory()
        return out

    return run


def powers(n: int, base: int = _MULT) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, grown on demand and kept."""
    have = _POWERS.get((base, 0))
    if have is None or len(have[0]) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[(base, 0)] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; works on a copy."""
    x = x.astype(np.uint64, copy=True)
    for shift, mult in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(mult)
    x ^= x >> np.uint64(33)
    return x


def slices(table: pa.Table | pa.RecordBatch, limit: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Row ranges of about `limit` bytes of text (a longer single text stays whole); nulls become empty texts."""
    batches = table.to_batches() if isinstance(table, pa.Table) else [table]
    for batch in batches:
        if not batch.num_rows:
            continue
        i = batch.schema.get_field_index(column)
        text = batch.column(i)
        if text.type != pa.string():
            text = text.cast(pa.string())
        batch = batch.set_column(i, column, text.fill_null("") if text.null_count else text)
        off = offsets(batch.column(i))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def offsets(text: pa.StringArray) -> np.ndarray:
    return np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)


def raw(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts after each other, and the offset of each text in them."""
    off = offsets(text)
    data = text.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


class Words:
    """Words of a slice of texts. start, end: byte bounds in buf; doc: row of each word; count: words of each row."""

    def __init__(self, text: pa.StringArray, table: np.ndarray = LOWER):
        data, self.off = raw(text)
        self.buf = table[data]
        self._find(self.buf != SPACE)

    @classmethod
    def of(cls, buf: np.ndarray, off: np.ndarray, inside: np.ndarray) -> Words:
        self = cls.__new__(cls)
        self.buf, self.off = buf, off
        self._find(inside)
        return self

    def _find(self, inside: np.ndarray) -> None:
        n = len(inside)
        firsts = self.off[:-1][self.off[:-1] < n]
        edge = np.zeros(n + 1, dtype=bool)
        edge[firsts] = edge[n] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        before &= ~edge[:-1]
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(self.off[1:], self.start, side="right")
        self.count = np.bincount(self.doc, minlength=len(self.off) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial hash of each word's bytes, finalised with its length."""
        return span_hash(self.buf, self.start, self.end)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words from start to end, in order; a word above HASHED bytes is hashed by its pieces."""
    out, at = [], 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + HASHED, side="right")))
        first, last = int(start[at]), int(end[to - 1])
        if last - first > HASHED:
            cuts = np.arange(0, last - first, HASHED)
            pieces = np.concatenate([_span_hash(buf[first + c : min(first + c + HASHED, last)], np.array([0]), np.array([min(HASHED, last - first - c)])) for c in cuts.tolist()])
            out.append(mix(np.bitwise_xor.reduce(pieces * (2 * np.arange(len(pieces), dtype=np.uint64) + np.uint64(1)))[None]))
        else:
            out.append(_span_hash(buf[first:last], start[at:to] - first, end[at:to] - first))
        at = to
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def _span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of lengths, after each other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def by_group(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The order by group and, inside, by the leading bits of a 64-bit key (52 of them for 4096 groups): equal keys stand together."""
    bits = int(group.max()).bit_length() if len(group) else 0
    return np.argsort(group.astype(np.uint64) << np.uint64(64 - bits) | key >> np.uint64(bits)) if bits else np.argsort(key)
