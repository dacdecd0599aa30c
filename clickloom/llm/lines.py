"""Operator 2: near-duplicate lines removed by an exact set-similarity join.

A line is the set of its words (A-Z lowered). Lines with equal sets form a class, whose first line is the smallest by
(doc_id, line number). Words are ordered by rarity, read from a table of 2**20 hashed counts (1 MB, whatever the corpus).
A class is indexed under the rarest words of its prefix, so that two classes of Jaccard similarity `percent` or more
share an indexed word; where a prefix word is frequent (HOT or more lines), under pairs of words instead, so that no
group grows with a frequent word. Entries under one key stand in order of length and position, and only those meet that
pass both filters: lines of one template with too many words of their own never do. Of those that meet, the parity of
their words' bits (64, or 192 for long lines) bounds the words that only one of two sets has. Lines of one template that
are similar in fact all meet under its key, which takes the square of their number.

A class needs one similar earlier class to go. Each is verified on its words against its most alike candidate first; only
classes that this leaves undecided meet all their other candidates. All lines of a class that goes, and all but the
first of one that stays, are removed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .arrays import LOWER, Words, by_group, lean, lean_bucket, lean_group, mix, ragged, raw, slices
from .store import Scratch

PERCENT, HOT, BLOCK, MAX_SENT = 80, 1 << 14, 1 << 12, 1_000_000
LONG = 96  # words from which a line has 192 parity bits
BUCKET_BYTES = 16 << 20
_COUNTS, _SEGMENTS = 1 << 20, 64
_STEP = np.uint64(0x9FB21C651E98DF25)
_ENTRY = np.dtype([("word", "<u4"), ("cls", "<u4"), ("order", "<i8"), ("line", "<u4"), ("n", "<u4"), ("at", "<u4"), ("bits", "<u8")])
_TOP = ("order", "line", "cls")  # what names a class: where its first line stands, and 32 bits of its id


class Lines:
    """Words of the lines of a slice; line: running number of each word's line, by which `doc` and `number` are indexed."""

    def __init__(self, text: pa.StringArray):
        data, off = raw(text)
        self.words = Words(text, LOWER)
        breaks = np.flatnonzero(data == 10)
        owner = np.searchsorted(off[1:], breaks, side="right")
        each = np.bincount(owner, minlength=len(off) - 1) + 1
        self.line = np.searchsorted(breaks, self.words.start) + self.words.doc
        self.doc = np.repeat(np.arange(len(each)), each)
        self.number = np.arange(len(self.doc)) - np.repeat(np.cumsum(each) - each, each)
        self.hash = self.words.hashes()

    def distinct(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each line's distinct words, by line and `key`: their lines and hashes."""
        order = by_group(self.line, key)
        line, h = self.line[order], self.hash[order]
        new = np.ones(len(line), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
        return line[new], h[new]


def _class_ids(line: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with words: its number, where its words start, and two sums over its word hashes."""
    names, first = np.unique(line, return_index=True)
    if not len(names):
        return names, first, h.view(np.int64), h.view(np.int64)
    return names, first, np.add.reduceat(mix(h), first).view(np.int64), np.add.reduceat(mix(h * _STEP), first).view(np.int64)


def _short(c1: np.ndarray) -> np.ndarray:
    return (c1.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _places(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(_COUNTS - 1)).astype(np.int64)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line with words; at the end of a partition its hashed word counts, by segment."""
    counts, names = np.zeros(_COUNTS, dtype=np.int64), ["order", "th", "line", "c1", "c2", "n", "segment", "counts"]
    for whole in batches:
        for batch in slices(whole):
            lines = Lines(batch.column("text"))
            line, h = lines.distinct(lines.hash)
            counts += np.bincount(_places(h), minlength=_COUNTS)
            used, first, c1, c2 = _class_ids(line, h)
            n, rows = np.diff(np.append(first, len(h))), pa.array(lines.doc[used])
            none = pa.nulls(len(used), pa.int32()), pa.nulls(len(used), pa.binary())
            yield pa.record_batch([batch.column("order").take(rows), batch.column("th").take(rows), pa.array(lines.number[used], pa.int64()), pa.array(c1), pa.array(c2), pa.array(n, pa.int64()), *none], names)
    parts = [zlib.compress(p.astype("<i8").tobytes(), 1) for p in np.split(counts, _SEGMENTS)]
    yield pa.record_batch([*[pa.nulls(_SEGMENTS, pa.int64())] * 6, pa.array(range(_SEGMENTS), pa.int32()), pa.array(parts, pa.binary())], names)


def _rarity(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a segment over all partitions, on a scale of eighths of powers of two."""
    total = np.zeros(_COUNTS // _SEGMENTS, dtype=np.int64)
    for batch in batches:
        for part in batch.column("counts"):
            total += np.frombuffer(zlib.decompress(part.as_py()), dtype="<i8")
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([_scale(total).tobytes()], pa.binary())], ["segment", "scale"])


def _scale(count: np.ndarray) -> np.ndarray:
    return np.minimum(8 * np.log2(np.maximum(count, 1)), 255).astype(np.uint8)


def prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """Two sets of similarity percent/100 share a word among the first n - ceil(percent * n / 100) + 1 of each."""
    return n - (percent * n + 99) // 100 + 1


def _keys(h: np.ndarray, first: np.ndarray, n: np.ndarray, hot: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The index entries of each set: its number, the hashed key, and the words before the last one that the key names.

    Words stand in order of rarity, so all that follow a hot one are hot. A similar set shares ceil(percent * n / 100) words
    or more; if the first of them is hot, then the second is one of the first len(prefix) + 1 words too.
    """
    long = prefix(n, percent)
    at, owner = ragged(long), np.repeat(np.arange(len(n)), long)
    word = h[np.repeat(first, long) + at]
    often = hot[np.repeat(first, long) + at]
    alone = ~often | ((percent * n + 99) // 100 < 2)[owner]  # sets that may share a single word keep it as a key as well
    owners, keys, ats = [owner[alone]], [mix(word[alone])], [at[alone]]
    owner, at, word = owner[often], at[often], word[often]
    more = np.minimum(long[owner] + 1, n[owner]) - at - 1  # second words of each hot one
    second = np.repeat(at, more) + 1 + ragged(more)
    owner, word = np.repeat(owner, more), np.repeat(word, more)
    owners.append(owner)
    keys.append(mix(mix(word * _STEP) + h[first[owner] + second]))
    ats.append(second - 1)
    return np.concatenate(owners), np.concatenate(keys), np.concatenate(ats)


def _parity(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of three words for each set: 64 bits, each the parity of the set's words that fall on it, and a part of these
    words' bits, twice; the first xor the others is the third part. Sets that differ in a bit differ in a word there.
    """
    bit, part = np.uint64(1) << (h >> np.uint64(58)), (h >> np.uint64(48)) % np.uint64(3)
    rows = [np.bitwise_xor.reduceat(x, first) for x in (bit, np.where(part == 1, bit, np.uint64(0)), np.where(part == 2, bit, np.uint64(0)))]
    return np.stack(rows, axis=1)


def _packed(entry: np.ndarray) -> bytes:
    """Entries byte by byte of their fields, so that leading zeros stand together and compress away."""
    return entry.view(np.uint8).reshape(len(entry), _ENTRY.itemsize).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(_ENTRY.itemsize, -1).T.copy().view(_ENTRY).reshape(-1)


def _index(scale, percent: int, hot: int, buckets: int):
    limit = int(_scale(np.array([hot]))[0])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = np.frombuffer(scale.value, dtype=np.uint8)
        for whole in batches:
            found = []
            for batch in slices(whole):
                lines = Lines(batch.column("text"))
                rank = rarity[_places(lines.hash)].astype(np.uint64) << np.uint64(56) | lines.hash >> np.uint64(8)
                line, h = lines.distinct(rank)
                used, first, c1, _ = _class_ids(line, h)
                if not len(used):
                    continue
                n = np.diff(np.append(first, len(h)))
                parity = _parity(h, first)
                order, number = batch.column("order").to_numpy()[lines.doc[used]], lines.number[used]
                by_class = np.lexsort((number, order, c1))
                new = np.ones(len(used), dtype=bool)
                new[1:] = c1[by_class][1:] != c1[by_class][:-1]
                once = by_class[new]
                once = once[100 * n[once] >= percent * (n[once] + 1)]  # smaller sets have no similar set but their equals
                owner, key, at = _keys(h, first[once], n[once], rarity[_places(h)] >= limit, percent)
                owner = once[owner]
                entry = np.empty(len(key), dtype=_ENTRY)
                entry["word"], entry["cls"], entry["n"], entry["at"], entry["bits"] = key >> np.uint64(32), _short(c1)[owner], n[owner], at, parity[owner, 0]
                entry["order"], entry["line"] = order[owner], number[owner]
                found.append(((key & np.uint64(0xFFFFFFFF)) % np.uint64(buckets), entry, parity[owner, 1:]))
            if not found:
                continue
            bucket, entry, more = (np.concatenate(x) for x in zip(*found, strict=True))
            by_bucket = np.argsort(bucket, kind="stable")
            entry, more = entry[by_bucket], more[by_bucket]
            names, first = np.unique(bucket[by_bucket], return_index=True)
            parts = [(_packed(e), m[e["n"] >= LONG].tobytes()) for e, m in zip(np.split(entry, first[1:]), np.split(more, first[1:]), strict=True)] if len(names) else []
            yield pa.record_batch([pa.array(names.astype(np.int64)), *(pa.array([x[k] for x in parts], pa.binary()) for k in (0, 1))], ["bucket", "entries", "more"])

    return index


def _apart(v: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The parity bits in which x and y differ."""
    whole, one, two = (v[c][x] ^ v[c][y] for c in ("bits", "bits1", "bits2"))
    both = (v["n"][x] >= LONG) & (v["n"][y] >= LONG)
    return np.where(both, np.bitwise_count(one).astype(np.int64) + np.bitwise_count(two) + np.bitwise_count(whole ^ one ^ two), np.bitwise_count(whole))


def _fits(v: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Length, position and difference filters of entries x and y under the same word: the first word that two similar sets
    share leaves, with itself, enough words in both for the overlap that their sizes ask for; and each bit whose parity
    differs stands for a word that one of both lacks.
    """
    nx, ny = v["n"][x], v["n"][y]
    left = np.minimum(nx - v["at"][x], ny - v["at"][y])
    ok = (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & ((100 + percent) * left >= percent * (nx + ny))
    ok[ok] = (100 + percent) * _apart(v, x[ok], y[ok]) <= (100 - percent) * (nx + ny)[ok]
    return ok


def _ranges(group: np.ndarray, n: np.ndarray, at: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries, and where the partners that they must meet begin and end, for entries in order of group, length and position.

    An entry meets those of its group that follow it, a length at a time. The longer ones must not be too long; of one
    length, only the first can leave enough words after the shared one, so pairs that can't be similar are never formed.
    """
    new = np.append(True, (group[1:] != group[:-1]) | (n[1:] != n[:-1]))
    start = np.flatnonzero(new)
    block = np.cumsum(new) - 1
    place = block << 32 | at
    i, ahead = np.arange(len(group)), 0
    while len(i):
        i = i[block[i] + ahead < len(start)]
        to = block[i] + ahead
        long = n[start[to]]
        need = -(-percent * (n[i] + long) // (100 + percent))  # words that both must have from the shared one on
        near = (group[start[to]] == group[i]) & (100 * n[i] >= percent * long) & (n[i] - at[i] >= need)  # and so for all that is longer
        i, to, last = i[near], to[near], (long - need)[near]
        first, end = np.maximum(start[to], i + 1), np.searchsorted(place, to << 32 | np.maximum(last, 0), side="right")
        some = (first < end) & (last >= 0)
        if some.any():
            yield i[some], first[some], end[some]
        ahead += 1


_FOUND = "word long, order long, line long, cls long, order_a long, line_a long, cls_a long, apart int, n long, at long, bits long, bits1 long, bits2 long, several boolean"


def _candidates(percent: int):
    def candidates(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (order, line, cls, order_a, line_a, cls_a, apart) for each class and word with candidates: the most alike
        earlier one. Under words where a class has several candidates, also a row (word, order, line, cls, n, at, bits...,
        several) for each class with a candidate or a later partner; several: that class has several candidates.
        """
        given, longer = [], []
        for batch in batches:
            given += [_unpacked(x.as_py()) for x in batch.column("entries")]
            longer += [np.frombuffer(x.as_py(), dtype=np.uint64).reshape(-1, 2) for x in batch.column("more")]
        e = np.concatenate(given)
        more = np.zeros((len(e), 2), dtype=np.uint64)
        more[e["n"] >= LONG] = np.concatenate(longer)
        by_class = np.lexsort((e["line"], e["order"], e["bits"], e["word"].astype(np.uint64) << np.uint64(32) | e["cls"]))
        e, more = e[by_class], more[by_class]
        new = np.ones(len(e), dtype=bool)
        new[1:] = (e["word"][1:] != e["word"][:-1]) | (e["cls"][1:] != e["cls"][:-1]) | (e["bits"][1:] != e["bits"][:-1]) | (e["n"][1:] != e["n"][:-1])
        e, more = e[new], more[new]
        by_length = np.lexsort((e["at"], e["n"], e["word"]))
        e, more = e[by_length], more[by_length]
        v = {c: e[c].astype(np.int64) for c in ("order", "line", "cls", "n", "at")} | {"bits": e["bits"], "bits1": more[:, 0], "bits2": more[:, 1]}
        rank = np.empty(len(e), dtype=np.int64)
        rank[np.lexsort((v["cls"], v["line"], v["order"]))] = np.arange(len(e))
        starts = np.flatnonzero(np.append(True, e["word"][1:] != e["word"][:-1]))
        size = np.diff(np.append(starts, len(e)))
        group = np.repeat(np.arange(len(size)), size)
        count, least, partner, met = np.zeros(len(e), np.int64), np.full(len(e), 1 << 30), np.full(len(e), -1), np.zeros(len(e), bool)
        for alive, first, end in _ranges(group, v["n"], v["at"], percent):
            alone = len(np.unique(first)) == len(first)  # and so after each step, as all go on together
            while len(alive):
                some = _fits(v, alive, first, percent)
                x, y = alive[some], first[some]
                apart = _apart(v, x, y)
                met[x] = met[y] = True
                for early, late in ((x, y), (y, x)):
                    now = rank[early] < rank[late]
                    a, b, d = early[now], late[now], apart[now]
                    if late is x or alone:  # each stands once among them
                        count[b] += 1
                    else:
                        np.add.at(count, b, 1)
                        far = np.argsort(-d, kind="stable")  # of several partners the nearest is set last, and stays
                        a, b, d = a[far], b[far], d[far]
                    better = d < least[b]
                    least[b[better]], partner[b[better]] = d[better], a[better]
                first = first + 1
                more = first < end
                alive, first, end = alive[more], first[more], end[more]
        b = np.flatnonzero(count)
        a = partner[b]
        crowd = np.flatnonzero(met & np.isin(group, group[count > 1]))
        word = (key[0].as_py() << 32) + e["word"][crowd].astype(np.int64)
        one, two = len(b), len(crowd)
        none = lambda n, t=pa.int64(): pa.nulls(n, t)
        names = [x.split()[0] for x in _FOUND.split(", ")]
        yield pa.record_batch([none(one), *(pa.array(v[c][b]) for c in _TOP), *(pa.array(v[c][a]) for c in _TOP), pa.array(least[b], pa.int32()), *[none(one)] * 5, none(one, pa.bool_())], names)
        yield pa.record_batch([pa.array(word), *(pa.array(v[c][crowd]) for c in _TOP), none(two), none(two), none(two), none(two, pa.int32()), pa.array(v["n"][crowd]), pa.array(v["at"][crowd]), *(pa.array(v[c][crowd].view(np.int64)) for c in ("bits", "bits1", "bits2")), pa.array(count[crowd] > 1)], names)

    return candidates


def _line_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """order, line, cls and text of the wanted lines of each document."""
    for batch in batches:
        orders, numbers, found = [], [], []
        for order, text, wanted in zip(batch.column("order").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
            parts = (text.as_py() or "").split("\n")
            for k in wanted:
                if k < len(parts):  # another text of this id may hold the line
                    orders.append(order)
                    numbers.append(k)
                    found.append(parts[k])
        table = pa.table({"order": pa.array(orders, pa.int64()), "line": pa.array(numbers, pa.int64()), "text": pa.array(found, pa.string())})
        for part in slices(table):
            lines = Lines(part.column("text"))
            used, _, c1, _ = _class_ids(*lines.distinct(lines.hash))
            yield pa.record_batch([part.column("order").take(pa.array(used)), part.column("line").take(pa.array(used)), pa.array(_short(c1).astype(np.int64)), part.column("text").take(pa.array(used))], ["order", "line", "cls", "text"])


def _words(text: str) -> set[bytes]:
    return set(text.encode().lower().split())


def _alike(percent: int):
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The classes (order, line, cls) whose words reach the similarity with text_a's."""
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text").to_pylist(), strict=True):
                x, y = _words(x), _words(y)
                met = len(x & y)
                keep.append(100 * met >= percent * (len(x) + len(y) - met))
            yield batch.filter(pa.array(keep, pa.bool_())).select(list(_TOP))

    return alike


def _compare(percent: int):
    def compare(table: pa.Table) -> pa.Table:
        """Of the undecided classes of a word's group (later = true), those similar to an earlier candidate (later = false)."""
        later, texts, sets = table.column("later").to_numpy(), table.column("text"), {}
        v = {c: table.column(c).to_numpy() for c in (*_TOP, "n", "at")} | {c: table.column(c).to_numpy().view(np.uint64) for c in ("bits", "bits1", "bits2")}
        rank = np.empty(len(later), dtype=np.int64)
        rank[np.lexsort((v["cls"], v["line"], v["order"]))] = np.arange(len(later))
        a, found = np.flatnonzero(~later), []

        def similar(i: int, b: int) -> bool:
            for k in (i, b):
                if k not in sets:
                    sets[k] = _words(texts[k].as_py())
            met = len(sets[i] & sets[b])
            return 100 * met >= percent * (len(sets[i]) + len(sets[b]) - met)

        for b in np.flatnonzero(later):
            early = a[rank[a] < rank[b]]
            early = early[(v["order"][early] != v["order"][b]) | (v["line"][early] != v["line"][b]) | (v["cls"][early] != v["cls"][b])]
            if any(similar(i, b) for i in early[_fits(v, early, np.full(len(early), b), percent)]):
                found.append(b)
        return table.select(list(_TOP)).take(pa.array(found, pa.int64()))

    return compare


class _Join:
    """docs: order, th, text."""

    def __init__(self, docs: DataFrame, percent: int, hot: int = HOT, block: int = BLOCK):
        spark = self.spark = docs.sparkSession
        self.percent, self.hot, self.block, self.docs, self.scratch = percent, hot, block, docs, Scratch(spark)
        self.found = self.scratch.settled(docs.mapInArrow(lean(_survey), "order long, th long, line long, c1 long, c2 long, n long, segment int, counts binary"))
        self.lines = self.found.filter("segment is null").select("order", "th", "line", "c1", "c2", "n")
        parts = self.found.filter("segment is not null").select("segment", "counts").groupBy("segment").applyInArrow(_rarity, "segment int, scale binary")
        scale = b"".join(r.scale for r in sorted(parts.collect(), key=lambda r: r.segment)) or bytes(_COUNTS)  # 1 MB
        self.scale = spark.sparkContext.broadcast(scale)

    def removed(self) -> DataFrame:
        """order, line, cls of the classes whose first line has an earlier similar line."""
        n = F.col("n")
        size = self.lines.agg(F.sum(n - F.ceil(n * self.percent / 100) + 1)).first()[0] or 0
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) * _ENTRY.itemsize // BUCKET_BYTES))
        index = self.docs.select("order", "text").mapInArrow(lean(_index(self.scale, self.percent, self.hot, buckets)), "bucket long, entries binary, more binary")
        found = self.scratch.settled(index.groupBy("bucket").applyInArrow(lean_bucket(_candidates(self.percent)), _FOUND))
        pairs = found.filter("word is null").groupBy(*_TOP, "order_a", "line_a", "cls_a").agg(F.min("apart").alias("apart"))
        best = pairs.groupBy(*_TOP).agg(F.min(F.struct("apart", "order_a", "line_a", "cls_a")).alias("m")).select(*_TOP, "m.order_a", "m.line_a", "m.cls_a")
        best = self.scratch.settled(best)
        gone = self.scratch.settled(self.verified(best))
        # classes left: their most alike candidates under other words, and all candidates under words with several
        pair = [*_TOP, "order_a", "line_a", "cls_a"]
        members = found.filter("word is not null").select("word", *_TOP, "n", "at", "bits", "bits1", "bits2", "several")
        undecided = self.scratch.settled(members.filter("several").join(gone, list(_TOP), "left_anti").select("word", *_TOP))
        rest = self.scratch.settled(pairs.select(pair).join(gone, list(_TOP), "left_anti").join(best, pair, "left_anti"))
        groups = undecided.select("word").distinct()
        some = members.drop("several").join(groups, "word", "left_semi").join(undecided.withColumn("open", F.lit(True)), ["word", *_TOP], "left")
        some = self.scratch.settled(some)
        out = self.scratch.settled(gone.union(self.verified(rest)).union(self.crowds(some)).distinct())
        self.scratch.drop(found, best, undecided, rest, some, gone)
        return out

    def crowds(self, members: DataFrame) -> DataFrame:
        """Undecided classes with a similar earlier class in their word's group; groups above `block` members are split into
        blocks of candidates and undecided ones, which meet in pairs of blocks.
        """
        size = members.groupBy("word").agg(F.ceil(F.count("*") / self.block).cast("int").alias("k"))
        texts = self.scratch.settled(self.texts(members))
        rows = members.join(texts, list(_TOP)).join(size, "word").withColumn("own", F.pmod(F.xxhash64(*_TOP), F.col("k")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
        cells = ["word", *_TOP, "n", "at", "bits", "bits1", "bits2", "text"]
        early = rows.select(*cells, F.lit(False).alias("later"), F.col("own").alias("i"), other).withColumnRenamed("other", "j")
        late = rows.filter("open").select(*cells, F.lit(True).alias("later"), F.col("own").alias("j"), other).withColumnRenamed("other", "i")
        return early.unionByName(late).groupBy("word", "i", "j").applyInArrow(lean_group(_compare(self.percent)), "order long, line long, cls long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The classes of pairs (order, line, cls, order_a, line_a, cls_a) that are similar enough to their partner."""
        ends = pairs.select(*_TOP).union(pairs.select("order_a", "line_a", "cls_a"))
        texts = self.scratch.settled(self.texts(ends))
        other = texts.select(*(F.col(c).alias(f"{c}_a") for c in (*_TOP, "text")))
        both = pairs.join(other, ["order_a", "line_a", "cls_a"]).join(texts, list(_TOP))
        return both.select(*_TOP, "text_a", "text").mapInArrow(lean(_alike(self.percent)), "order long, line long, cls long").distinct()

    def texts(self, ends: DataFrame) -> DataFrame:
        """order, line, cls, text of some lines. Up to MAX_SENT line numbers are broadcast, so texts aren't shuffled."""
        ends = self.scratch.settled(ends.groupBy(F.col("order").alias("at")).agg(F.collect_set("line").alias("wanted")))
        wanted = ends.agg(F.sum(F.size("wanted"))).first()[0] or 0
        ends = F.broadcast(ends) if wanted <= MAX_SENT else ends
        texts = self.docs.join(ends, F.col("order") == F.col("at")).select("order", "text", "wanted")
        return texts.mapInArrow(lean(_line_texts), "order long, line long, cls long, text string").dropDuplicates(list(_TOP))

    def state(self) -> DataFrame:
        """c1, c2, top, similar of the classes that lose lines."""
        classes = self.lines.groupBy("c1", "c2").agg(F.min(F.struct("order", "line", "th")).alias("top"), F.count("*").alias("lines"))
        classes = classes.withColumns({"order": F.col("top.order"), "line": F.col("top.line"), "cls": F.col("c1").bitwiseAND(F.lit(0xFFFFFFFF))})
        gone = self.removed().withColumn("similar", F.lit(True))
        out = classes.join(gone, list(_TOP), "left").filter(F.col("similar") | (F.col("lines") > 1))
        return out.select("c1", "c2", "top", F.coalesce("similar", F.lit(False)).alias("similar"))


def _ordered(docs: DataFrame) -> tuple[DataFrame, Column]:
    """docs with a column to order its rows by doc_id, and that order: the id itself, or its rank where ids are no integers."""
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    ranks = docs.select("doc_id").distinct().orderBy(F.col("doc_id").asc_nulls_first()).select(F.col("doc_id").alias("at_id"), F.monotonically_increasing_id().alias("rank"))
    ranks = Scratch(docs.sparkSession).settled(ranks)
    return docs.join(ranks, F.col("doc_id").eqNullSafe(F.col("at_id"))), F.col("rank")


def dedup_lines(docs: DataFrame, percent: int = PERCENT, column: str = "lines", hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """docs with a struct column (`lines`, or another name that docs lacks): n (lines), gone (numbers of removed lines, from 0), text (what is left).

    Lines are parts of the text between newlines; lines without words stay. A null text has no lines and stays null; a
    text that loses all lines is empty. Rows with equal doc_id and text count as one document; lines of rows that share an
    id but not the text stand in order of line number and text hash. A null id comes first.
    """
    names = docs.columns
    rows = docs.select(F.struct("*").alias("given"), "doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("th"))
    rows, order = _ordered(rows)
    rows = rows.select("given", order.alias("order"), "th", "text")
    join = _Join(rows.select("order", "th", "text"), percent, hot, block)
    state = join.scratch.settled(join.state())
    marked = join.lines.join(state, ["c1", "c2"]).filter(F.col("similar") | (F.struct("order", "line", "th") != F.col("top")))
    lists = marked.groupBy(F.col("order").alias("at"), F.col("th").alias("at_th")).agg(F.sort_array(F.collect_set(F.col("line").cast("int"))).alias("gone"))
    lists = join.scratch.settled(lists)
    join.scratch.drop(join.found, state)
    numbers = lists.agg(F.sum(F.size("gone"))).first()[0] or 0
    lists = F.broadcast(lists) if numbers <= MAX_SENT else lists
    out = rows.join(lists, (F.col("order") == F.col("at")) & (F.col("th") == F.col("at_th")), "left")
    out = out.select("given", "text", "gone", F.split("text", "\n", -1).alias("parts"))
    keep = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda i: F.get("parts", i)), "\n"))
    none = F.array().cast("array<int>")
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("parts"))
    return out.select(*(F.col("given")[c].alias(c) for c in names), F.struct(n.cast("long").alias("n"), F.coalesce("gone", none).alias("gone"), text.alias("text")).alias(column))


# Classes of equal word sets; those of similarity 0.8 share one of their rarest words, as many as the prefix has.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, i, line, list_sort(list_distinct(list_filter(
    string_split_regex(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS s FROM l
), c AS (
  SELECT s, len(s) AS n, row_number() OVER (ORDER BY min((doc_id, i))) AS k FROM w WHERE len(s) > 0 GROUP BY s
), x AS (
  SELECT k, n, unnest(s) AS word FROM c
), r AS (
  SELECT k, n, word, row_number() OVER (PARTITION BY k ORDER BY df, word) AS place FROM x JOIN (SELECT word, count(*) AS df FROM x GROUP BY word) USING (word)
), p AS (
  SELECT k, n, word FROM r WHERE place <= n - (4 * n + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT a.k AS earlier, b.k AS later FROM p a JOIN p b ON a.word = b.word AND a.k < b.k AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), alike AS (
  SELECT DISTINCT later AS k
  FROM (SELECT later, a.n + b.n AS total, len(list_intersect(a.s, b.s)) AS shared FROM pairs JOIN c a ON a.k = earlier JOIN c b ON b.k = later)
  WHERE 100 * shared >= 80 * (total - shared)
), judged AS (
  SELECT doc_id, i, line, len(s) > 0 AND (alike.k IS NOT NULL OR row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1) AS gone
  FROM w LEFT JOIN c USING (s) LEFT JOIN alike ON alike.k = c.k
), t AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, t.text FROM documents d LEFT JOIN t USING (doc_id)
"""
