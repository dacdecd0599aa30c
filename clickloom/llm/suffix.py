"""Operator 13: removal of byte strings of `length` bytes or more that occur twice, by a sparse suffix array.

Each string of `length` bytes (a window) has an anchor: where the smallest of its GRAM-byte hashes stands, leftmost of
equals. Equal windows have their anchors at the same place, so only suffixes that start at anchors need to be sorted:
about 2 in length - GRAM bytes. Grams are counted over the corpus by hash; anchors whose gram occurs once lie in no
repeated window. The others send their context: the bytes that the anchor's windows cover. Equal contexts become one row.

Contexts are range-partitioned by the gram that their suffix begins with, with Spark's sampled splitters, and sorted in
each bucket by multikey quicksort, eight bytes at a time; the bytes before the anchor are sorted alike. From the common
prefixes of neighbours in both orders follows which windows of a gram's group are equal, byte by byte. A gram with more
than `bucket_rows` different contexts is partitioned by the whole suffix (and then what stands before it), so that its
group is split over many buckets. Where such a group reaches the edge of a bucket, its windows are compared across
buckets: each bucket names every different one once by 128 bits of hashes, and those named twice are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import mix, offsets, powers, slices
from .store import Scratch

LENGTH, GRAM, PIECE = 400, 128, 1 << 19
BUCKET_ROWS = 1 << 15
_BASES = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
_BYTE = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(20)  # bits for a place within a piece; pieces and slices are shorter than 2**20 bytes


def rolling(buf: np.ndarray, k: int, base: int = _BASES[0]) -> np.ndarray:
    """A 64-bit polynomial hash of the k bytes from each place on."""
    if len(buf) < k:
        return np.empty(0, dtype=np.uint64)
    up, down = powers(len(buf) + 1, base)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up[:-1], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: len(buf) - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each w values that follow each other."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).reshape(-1)
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def anchors(buf: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows in texts that end at `ends`: their place, how far their first and last window start before them, hash."""
    none = np.empty(0, dtype=np.int64)
    if len(buf) < length:
        return none, none, none, none.view(np.uint64)
    h = rolling(buf, gram)
    least = sliding_min((h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    at = np.arange(len(least))
    inside = at + length <= ends[np.searchsorted(ends, at, side="right")]
    start, anchor = at[inside], (least[inside] & np.uint64((1 << 20) - 1)).astype(np.int64)
    if not len(start):
        return none, none, none, none.view(np.uint64)
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(new[1:], len(start)) - 1
    place = anchor[new]
    return place, place - start[new], place - start[last], h[place]


def _pieces(batch: pa.RecordBatch, length: int, piece: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, ends of texts, row and offset of each text, for slices of a batch; long texts in pieces that share length - 1 bytes."""
    row = 0
    for part in slices(batch, piece):
        text = part.column("text")
        off = offsets(text)
        data = text.buffers()[2]
        buf = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, dtype=np.uint8)
        if part.num_rows == 1 and len(buf) > piece:
            for at in range(0, len(buf) - length + 1, piece):
                some = buf[at : at + piece + length - 1]
                yield some, np.array([len(some)]), np.array([row]), np.array([at])
        else:
            yield buf, off[1:] - off[0], np.arange(row, row + part.num_rows), off[0] - off[:-1]
        row += part.num_rows


def _find(length: int, gram: int, piece: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """r1, r2 (the text), gram (hash), at (byte), most, least of each anchor."""
        for batch in batches:
            for buf, ends, rows, shift in _pieces(batch, length, piece):
                place, most, least, h = anchors(buf, ends, length, gram)
                if not len(place):
                    continue
                text = np.searchsorted(ends, place, side="right")
                of = pa.array(rows[text])
                at = place + shift[text]
                yield pa.record_batch([batch.column("r1").take(of), batch.column("r2").take(of), pa.array(h.view(np.int64)), pa.array(at), pa.array(most, pa.int32()), pa.array(least, pa.int32())], ["r1", "r2", "gram", "at", "most", "least"])

    return find


def _contexts(length: int):
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes from each wanted anchor on and then, in the same key, those before it."""
        for batch in batches:
            for part in slices(batch):
                keys, rows, fields = [], [], []
                for row, (text, wanted) in enumerate(zip(part.column("text"), part.column("wanted").to_pylist(), strict=True)):
                    data = text.as_py().encode()
                    for a in wanted:
                        at, most, least = a["at"], a["most"], a["least"]
                        keys.append(data[at : at - least + length] + data[at - most : at])
                        fields.append((at, most, least))
                        rows.append(row)
                of = pa.array(rows, pa.int64())
                names = ["r1", "r2", "at", "most", "least", "key"]
                for i in range(0, len(keys), 1 << 14):
                    j = slice(i, i + (1 << 14))
                    yield pa.record_batch([part.column("r1").take(of[j]), part.column("r2").take(of[j]), *(pa.array([f[k] for f in fields[j]], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))), pa.array(keys[j], pa.binary())], names)

    return contexts


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as big-endian words of eight, which compare as the bytes do."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64)


def multikey_sort(rows: np.ndarray) -> np.ndarray:
    """The order of byte rows of one width: all segments of equal beginnings are split by their next word at once, until none is left."""
    words = _words(rows)
    order, segment, open_ = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    for depth in range(words.shape[1]):
        if not len(open_):
            break
        who, seg = order[open_], segment[open_]
        word = words[who, depth]
        by = np.lexsort((word, seg))
        who, seg, word = who[by], seg[by], word[by]
        order[open_] = who
        new = np.append(True, (seg[1:] != seg[:-1]) | (word[1:] != word[:-1]))
        segment[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]  # named by where it starts
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
    return order


def common_prefix(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row in order has in common with the one before it; 0 for the first."""
    out = np.zeros(len(order), dtype=np.int64)
    for a in range(1, len(order), 1 << 12):
        here = rows[order[a : a + (1 << 12)]] != rows[order[a - 1 : a - 1 + len(order[a : a + (1 << 12)])]]
        out[a : a + len(here)] = np.where(here.any(axis=1), here.argmax(axis=1), rows.shape[1])
    return out


def _spread(keys: list[bytes], start: np.ndarray, size: np.ndarray, width: int, backwards: bool) -> np.ndarray:
    """Each key's bytes from start, size of them, as rows of `width` padded by zeros; backwards: the last byte first."""
    data = np.frombuffer(b"".join(keys), dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum([len(k) for k in keys])])[:-1] + start
    column = np.arange(width)
    place = first[:, None] + ((size - 1)[:, None] - column if backwards else column)
    inside = column < size[:, None]
    return np.where(inside, data[np.where(inside, place, 0)], 0).astype(np.uint8)


def repeated_windows(keys: list[bytes], n: np.ndarray, most: np.ndarray, least: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's contexts: which lie in the first or last gram's group; and, for each place 0..length-gram before the
    anchor, whether the window that starts there occurs in two contexts, or in one found n > 1 times, and whether it stands
    for all windows equal to it.
    """
    size = np.array([len(k) for k in keys])
    right = _spread(keys, np.zeros(len(keys), dtype=np.int64), size - most, length, False)
    order = multikey_sort(right)
    same = common_prefix(right, order)
    group = np.empty(len(keys), dtype=np.int64)
    group[order] = np.cumsum(same < gram)
    edge = (group == group[order[0]]) | (group == group[order[-1]])
    out = np.zeros((len(keys), length - gram + 1), dtype=bool)
    column = np.arange(length - gram + 1)
    out[n > 1] = (column <= most[n > 1, None]) & (column >= least[n > 1, None])
    first = (column <= most[:, None]) & (column >= least[:, None])
    some = np.flatnonzero(np.bincount(group)[group] > 1)  # the others have no other context to be equal with
    if len(some):
        left = _spread([keys[i] for i in some], (size - most)[some], most[some], length - gram, True)
        by_left = multikey_sort(left)
        same_left = common_prefix(left, by_left)
        kept = np.zeros(len(keys), dtype=bool)
        kept[some] = True
        place = np.flatnonzero(kept[order])
        by_right = np.searchsorted(some, order[place])
        same_right = np.array([same[a + 1 : b + 1].min() for a, b in zip(place[:-1], place[1:], strict=True)], dtype=np.int64) if len(place) > 1 else np.empty(0, dtype=np.int64)
        same_right = np.append(0, same_right)
        rank_left, rank_right = np.empty(len(some), dtype=np.int64), np.empty(len(some), dtype=np.int64)
        for o in range(length - gram + 1):
            here = (most[some] >= o) & (least[some] <= o)
            if not here.any():
                continue
            rank_left[by_left], rank_right[by_right] = np.cumsum(same_left < o), np.cumsum(same_right < length - o)
            who = np.flatnonzero(here)
            name = rank_right[who] * (len(some) + 1) + rank_left[who]
            by = np.argsort(name, kind="stable")
            equal = name[by][1:] == name[by][:-1]
            twice = np.append(False, equal) | np.append(equal, False)
            out[some[who[by[twice]]], o] = True
            first[some[who[by[1:][equal]]], o] = False
    return edge, out, first


def _runs(hit: np.ndarray, length: int) -> list[list[int]]:
    """For each row of repeated windows by place before the anchor: starts and ends of the bytes that they cover, from the anchor."""
    step = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    out: list[list[int]] = [[] for _ in range(len(hit))]
    for (row, first), (_, after) in zip(np.argwhere(step > 0).tolist(), np.argwhere(step < 0).tolist(), strict=True):
        out[row] += [1 - after, length - first]
    return out


def _bucket(length: int, gram: int):
    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """spans (bytes to remove, from the anchor; flat) of each context; key and open (places of windows to compare) where a hot group reaches an edge of the bucket."""
        given = [b for b in batches if b.num_rows]
        if not given:
            return
        table = pa.Table.from_batches(given)
        keys, n, most, least = table.column("key").to_pylist(), *(table.column(c).to_numpy().astype(np.int64) for c in ("n", "most", "least"))
        edge, hit, first = repeated_windows(keys, n, most, least, length, gram)
        edge &= table.column("hot").to_numpy()
        spans = pa.array(_runs(hit, length), pa.list_(pa.int32()))
        left = pa.array([k if e else None for k, e in zip(keys, edge.tolist(), strict=True)], pa.binary())
        open_ = pa.array([np.flatnonzero(f) if e else None for f, e in zip(first, edge.tolist(), strict=True)], pa.list_(pa.int32()))
        yield from pa.table([*(table.column(c) for c in ("c1", "c2", "most")), spans, left, open_], ["c1", "c2", "most", "spans", "key", "open"]).to_batches(max_chunksize=1 << 12)

    return bucket


def _edge_windows(length: int):
    def edge_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """c1, c2, o, and two hashes of the window that starts o bytes before the anchor."""
        for batch in batches:
            for i in range(batch.num_rows):
                c1, c2, most, key, places = (batch.column(c)[i].as_py() for c in ("c1", "c2", "most", "key", "open"))
                if places:
                    text = np.frombuffer(key[len(key) - most :] + key[: len(key) - most], dtype=np.uint8)
                    w = [rolling(text, length, b).view(np.int64)[most - np.array(places)] for b in _BASES]
                    yield pa.record_batch([*(pa.array(np.full(len(places), c)) for c in (c1, c2)), pa.array(places, pa.int32()), pa.array(w[0]), pa.array(w[1])], ["c1", "c2", "o", "w1", "w2"])

    return edge_windows


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_removed, spans (merged, flat) and kept bytes of each text."""
    for batch in batches:
        for part in slices(batch):
            cuts, kept, gone = [], [], []
            for text, found in zip(part.column("text"), part.column("spans").to_pylist(), strict=True):
                data, merged = text.as_py().encode(), []
                for start, end in sorted((s["start"], s["end"]) for s in found or ()):
                    if merged and start <= merged[-1]:
                        merged[-1] = max(merged[-1], end)
                    else:
                        merged += [start, end]
                edges = [0, *merged, len(data)]
                kept.append(b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)) if merged else data)
                cuts.append(merged)
                gone.append(len(data) - len(kept[-1]))
            size = pa.array([k + g for k, g in zip(map(len, kept), gone, strict=True)], pa.int64())
            yield pa.record_batch([part.column("doc_id"), size, pa.array(gone, pa.int64()), pa.array(cuts, pa.list_(pa.int64())), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def _both(*columns: str) -> tuple[Column, Column]:
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *reversed(columns))


def _lists(rows: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """Structs of all columns but r1 and r2, collected for each text."""
    fields = [c for c in rows.columns if c not in ("r1", "r2")]
    return scratch.settled(rows.groupBy("r1", "r2").agg(F.collect_set(F.struct(*fields)).alias(name)))


def strip_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS, piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start and end byte of each removed run, flat) and kept (bytes) for each row.

    A byte goes if a string of `length` bytes that covers it starts anywhere else as well. Null texts are empty; a row given
    twice repeats itself; texts shorter than `length` keep all. Kept bytes need not be whole characters.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    r1, r2 = _both("doc_id", "text")
    docs = docs.withColumns({"r1": r1, "r2": r2})
    long = docs.filter(F.octet_length("text") >= length).select("r1", "r2", "text")
    found = scratch.settled(long.mapInArrow(_find(length, gram, piece), "r1 long, r2 long, gram long, at long, most int, least int"))
    twice = scratch.settled(found.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1").select("gram"))
    wanted = found.join(twice, "gram", "left_semi").select("r1", "r2", "at", "most", "least")
    texts = long.join(_lists(wanted, "wanted", scratch), ["r1", "r2"])
    found_at = texts.mapInArrow(_contexts(length), "r1 long, r2 long, at long, most int, least int, key binary")
    c1, c2 = _both("key", "most", "least")
    found_at = scratch.settled(found_at.withColumns({"c1": c1, "c2": c2}))
    scratch.drop(found, twice)
    once = scratch.settled(found_at.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.any_value("most").alias("most"), F.any_value("least").alias("least"), F.any_value("key").alias("key")))
    lead = F.substring("key", 1, gram)
    hot = once.groupBy(F.xxhash64(lead).alias("g")).agg(F.count("*").alias("k")).filter(F.col("k") > bucket_rows).select("g", F.lit(True).alias("hot"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-once.count() // bucket_rows))
    marked = once.withColumn("g", F.xxhash64(lead)).join(F.broadcast(hot), "g", "left")  # one hot gram for bucket_rows contexts at most
    marked = marked.withColumn("hot", F.coalesce("hot", F.lit(False))).withColumn("lead", F.when(F.col("hot"), F.col("key")).otherwise(lead))
    sorted_ = marked.repartitionByRange(buckets, "lead").select("c1", "c2", "n", "most", "least", "key", "hot")
    sorted_ = scratch.settled(sorted_.mapInArrow(_bucket(length, gram), "c1 long, c2 long, most int, spans array<int>, key binary, open array<int>"))
    windows = sorted_.filter("key is not null").select("c1", "c2", "most", "key", "open").mapInArrow(_edge_windows(length), "c1 long, c2 long, o int, w1 long, w2 long")
    across = windows.groupBy("w1", "w2").agg(F.count("*").alias("m")).filter("m > 1").select("w1", "w2")
    across = windows.join(across, ["w1", "w2"], "left_semi").select("c1", "c2", (-F.col("o")).alias("start"), (F.lit(length) - F.col("o")).alias("end"))
    places = F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2))
    inner = sorted_.filter("size(spans) > 0").select("c1", "c2", F.explode(F.transform(places, lambda i: F.struct(F.get("spans", i).alias("start"), F.get("spans", i + 1).alias("end")))).alias("s")).select("c1", "c2", "s.*")
    spans = found_at.select("r1", "r2", "at", "c1", "c2").join(inner.unionByName(across), ["c1", "c2"])
    spans = spans.select("r1", "r2", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.join(_lists(spans, "spans", scratch), ["r1", "r2"], "left").select("doc_id", "text", "spans")
    scratch.drop(found_at, once, sorted_)
    return out.mapInArrow(_strip, f"doc_id {kind}, n_bytes long, n_removed long, spans array<bigint>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", F.floor(F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Windows by hash of their bytes, starts that stand within a window's length joined to runs, what lies between runs kept as hex digits.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT r, s, md5(b[s:s + 399]) AS h FROM (SELECT r, b, unnest(range(1, n - 398)) AS s FROM d WHERE n >= 400)
), t AS (
  SELECT r, s, coalesce(s - lag(s) OVER (PARTITION BY r ORDER BY s) > 400, true) AS new FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)
), g AS (
  SELECT r, min(s) AS a, max(s) + 399 AS z FROM (SELECT r, s, sum(new::INT) OVER (PARTITION BY r ORDER BY s) AS k FROM t) GROUP BY r, k
), c AS (
  SELECT r, count(*) AS n_spans, sum(z - a + 1) AS n_removed FROM g GROUP BY r
), cut AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS after, a AS before FROM (SELECT r, a, z FROM g UNION ALL SELECT r, n + 1, n + 1 FROM d)
), kept AS (
  SELECT r, string_agg(hex(b)[2 * after + 1:2 * before - 2], '' ORDER BY before) AS k FROM cut JOIN d USING (r) GROUP BY r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN c USING (r)
"""
