"""Operator 8: documents packed into sequences of at most 1024 tokens by hierarchical best fit.

Documents are tokenised where they lie and cut if they are too long; their pieces are dealt to leaves of about LEAF pieces
by a hash, so that each leaf sees the lengths of the whole. A leaf packs its pieces by best fit, longest first. Bins that
are nearly full are final; underfull ones go up the tree as items, are dealt to fewer nodes and best-fitted again, round
by round, until one node holds all that is left or a round finds partners for hardly any. No bin is closed before its
last round, and no node holds more than about LEAF items.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import lean, lean_group, ragged, slices
from .store import Scratch

CAPACITY = 1024
END_ID = 2
LEAF = 1 << 16  # items of a node
SPARE = 64  # a bin with less than a 64th of its room left is nearly full
FEWEST = 100  # the tree ends when a round joins fewer than one bin of this many
SLICE = 4 << 20  # bytes of text whose stretches are encoded together
WORDS = 5_000  # stretches that the library encodes at a time
_SPACES = "\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # white space but blanks and newlines

_TOKENIZERS: dict[str, Ids] = {}


class Ids:
    """Token ids of texts. Pre-tokens don't cross a space or newline that stands alone, so texts are parted there and each
    distinct stretch of a batch is encoded once; texts with other white space or special strings are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.newline = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.opens = np.zeros(self.library.get_vocab_size() + 1, dtype=bool)  # ids that begin a stretch
        for word, number in self.library.get_vocab().items():
            self.opens[number] = word[0] == "Ġ"
        self.opens[self.newline] = True
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        # three newlines are two pre-tokens, as are two at the start, since a newline is set before each text
        self.odd = "|".join([r" [ \n]| \z|\A\n\n|\n\n[ \n]|\n\n\z", f"[{_SPACES}]", *special])

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _stretches(self, units: list[str]) -> pa.BinaryArray | None:
        """The ids of stretches that each follow a space or begin with a newline (none for an empty one); None if they can't
        be told apart.
        """
        parts, sizes = [], np.zeros(len(units) + 1, dtype=np.int64)
        for at in range(0, len(units), WORDS):
            some = units[at : at + WORDS]
            filled = at + 1 + np.flatnonzero(np.array(list(map(len, some))))
            some = list(filter(None, some))
            text = "".join(u if u[0] == "\n" else " " + u for u in some)
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(some):
                return None
            parts.append(ids)
            sizes[filled] = np.diff(np.append(starts, len(ids)))
        data = np.concatenate(parts) if parts else np.empty(0, dtype="<u4")
        return pa.Array.from_buffers(pa.binary(), len(units), [None, pa.py_buffer((np.cumsum(sizes) * 4).astype(np.int32)), pa.py_buffer(data)])

    def texts(self, texts: pa.StringArray) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        # a newline before each text and a space before each newline: every stretch follows a space
        split = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise("", plain, "\n"), "\n", " \n"), " ")
        words = split.flatten().dictionary_encode()
        # signs after a letter are pre-tokens of their own
        bare = pc.replace_substring_regex(words.dictionary, r"(\p{L})[.,;:!?#$%&*|]+$", r"\1")
        signs = pc.if_else(pc.equal(bare, words.dictionary), "", pc.replace_substring_regex(words.dictionary, r"(?s)^.*\p{L}", "")).dictionary_encode()
        bare = bare.dictionary_encode()
        known = self._stretches(bare.dictionary.to_pylist())
        after = pa.array([self.whole(x) for x in signs.dictionary.to_pylist()], pa.binary())
        if known is None:
            return [self.whole(t) for t in texts.to_pylist()]
        whole = pc.binary_join_element_wise(known.take(bare.indices), after.take(signs.indices), b"")
        data, ends = raw_bytes(whole.take(words.indices))
        rows = ends[np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))].tolist()
        found = (data[a + 4 : b] for a, b in zip(rows[:-1], rows[1:], strict=True))  # without the newline set before
        return [self.whole(t.as_py()) if o else next(found) for t, o in zip(texts, odd.tolist(), strict=True)]


def raw_bytes(values: pa.BinaryArray) -> tuple[bytes, np.ndarray]:
    """All values after each other, and where each begins, with the end."""
    if not len(values):
        return b"", np.zeros(1, dtype=np.int32)
    ends = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1]
    return (values.buffers()[2].to_pybytes() if values.buffers()[2] is not None else b""), ends


def ids_of(path: str) -> Ids:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Ids(path)
    return _TOKENIZERS[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """start and length of each piece: only texts above the capacity are cut, and only their first piece is shorter."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers: longest items first, each into the fullest bin that still takes it. What `plan` is held against."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: a bin with room r is open
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= size
        if room:
            by_room[room].append(b)
            open_rooms |= 1 << room
    return bins


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[int, np.ndarray]:
    """The bins of best fit, longest first, for `counts` items of each size: their number, and rows (size, first, each, bin, at).

    A row deals the items of a size from number `first` on, `each` of them to a bin, into bins from number `bin` on, which
    hold `at` tokens already. Bins filled alike are kept as one run: an item's best bin stays the best for the next item of
    its size while it has room. A size adds at most three runs and a run meets at most as many sizes as fit into a bin, so
    the plan is bounded by the capacity, whatever the number of items.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first bin and number of bins
    bins = 0
    for size in sorted(counts, reverse=True):
        done, left = 0, counts[size]
        for room in range(size, capacity + 1):
            each = room // size
            if room == capacity and left:
                runs[room].append((bins, -(-left // each)))
                bins += -(-left // each)
            while left and runs[room]:
                b, k = runs[room].pop()
                for part, most in ((min(k, left // each), each), (1, left % each)):
                    if left and k and part and most:
                        rows.append((size, done, most, b, capacity - room))
                        runs[room - most * size].append((b, part))
                        done, left, b, k = done + part * most, left - part * most, b + part, k - part
                if k:
                    runs[room].append((b, k))
    return bins, np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _pieces(path: str, end_id: int, capacity: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, SLICE):
                held.append(part)
                size += part.nbytes
                if size >= SLICE:
                    yield pa.concat_batches(held)
                    held, size = [], 0
        if held:
            yield pa.concat_batches(held)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each piece with a number of its own: that of the partition, then its place there."""
        from pyspark import TaskContext

        ids, at = ids_of(path), TaskContext.get().partitionId() << 36
        for part in large(batches):
            found = []
            for row, data in enumerate(ids.texts(part.column("text"))):
                data += end
                for piece, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    found.append((row, piece, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
            row, piece, start, length, crc = np.array(found, dtype=np.int64).T
            columns = [part.column("doc_id").take(pa.array(row)), *map(pa.array, (piece, start, crc, np.arange(at, at + len(row)), length))]
            at += len(row)
            yield pa.record_batch(columns, ["doc_id", "piece", "start", "ids_crc32", "item", "size"])

    return pieces


def place(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each item, by the plan of their sizes; items of a size are dealt in the order given."""
    order, counts = np.argsort(sizes, kind="stable"), np.bincount(sizes, minlength=capacity + 1)
    number = np.empty(len(sizes), dtype=np.int64)
    number[order] = ragged(counts)
    size, first, each, bins, at = plan({k: int(n) for k, n in enumerate(counts.tolist()) if n}, capacity)[1].T
    row = np.searchsorted((size << 48) + first, (sizes << 48) + number, side="right") - 1
    more, inside = np.divmod(number - first[row], each[row])
    return bins[row] + more, at[row] + inside * sizes


def fitted(items: DataFrame, level: int, nodes: int, capacity: int) -> DataFrame:
    """One round of the tree: items (item, size and any other columns), dealt to nodes, with bin, at and fill of the bin.

    Bin numbers are unique among all rounds. A node's items are sorted, so that a node that runs again packs alike.
    """

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        sizes = table.column("size").to_numpy()
        bins, at = place(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)[bins]
        bins = bins + (level << 56) + (table.column("node")[0].as_py() << 32)
        return pa.table([*table.drop(["node"]).columns, *map(pa.array, (bins, at, fill))], [*(c for c in table.column_names if c != "node"), "bin", "at", "fill"])

    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    node = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(nodes))
    return items.withColumn("node", node).groupBy("node").applyInArrow(lean_group(fit), f"{out}, bin long, at long, fill long")


def _merged(scratch: Scratch, leaves: DataFrame, leaf: int, capacity: int) -> DataFrame | None:
    """For the bins of leaves that go up the tree: their last bin and their place there."""

    def underfull(packed: DataFrame) -> DataFrame:
        return packed.filter((F.col("at") == 0) & (F.col("fill") <= capacity - capacity // SPARE)).select(F.col("bin").alias("item"), F.col("fill").alias("size"))

    moved, level = None, 0
    items = underfull(leaves)
    left = items.count()
    while left > 1:
        level += 1
        nodes = -(-left // leaf)
        up = scratch.settled(fitted(items, level, nodes, capacity))
        if moved is None:
            moved = up.select("item", "bin", "at")
        else:
            higher = up.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("at").alias("further"))
            ends = F.coalesce("to", "bin").alias("bin"), (F.col("at") + F.coalesce("further", F.lit(0))).alias("at")
            moved = scratch.settled(moved.join(higher, "bin", "left").select("item", *ends))
        joined = left - up.filter("at = 0").count()
        if nodes == 1 or joined * FEWEST < left:
            break
        items = underfull(up)
        left = items.count()
    return moved


def pack(docs: DataFrame, path: str, end_id: int = END_ID, capacity: int = CAPACITY, leaf: int = LEAF) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece.

    Null and empty texts are the end id alone. Repeated rows are packed each. An empty table gives no rows.
    path: a file of the tokenizers library, on every executor. leaf: items of a node, a bound of its memory.
    """
    scratch, kind = Scratch(docs.sparkSession), docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    pieces = scratch.settled(docs.mapInArrow(lean(_pieces(path, end_id, capacity)), f"doc_id {kind}, piece long, start long, ids_crc32 long, item long, size long"))
    nodes = max(1, math.ceil(pieces.count() / leaf))
    packed = scratch.settled(fitted(pieces, 0, nodes, capacity))
    scratch.drop(pieces)
    sequence, offset = F.col("bin"), F.col("at")
    if nodes > 1 and (moved := _merged(scratch, packed, leaf, capacity)) is not None:
        packed = packed.join(moved.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("at").alias("further")), "bin", "left")
        sequence, offset = F.coalesce("to", "bin"), F.col("at") + F.coalesce("further", F.lit(0))
    return packed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", F.col("size").alias("length"), "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))
