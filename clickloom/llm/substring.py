"""Operator 7: removal of token windows that occur more than once in a corpus.

Every window of 35 words gets a Rabin-Karp hash. Texts are dealt into blocks; a block sends its distinct window hashes,
dealt by a second hash into buckets, as one sorted byte string for each bucket. A bucket counts in how many blocks each
hash occurs and sends the repeated ones back; windows repeated inside a block are known there. Repeated windows are then
merged into maximal intervals of words, which go. 64 bits of one hash and the bucket number of the other must agree.
A hash sent by a third of all blocks still meets as one number for each block, so hot passages don't pile up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import KEEP, Words, mix, powers, slices
from .blocks import BLOCK_BYTES, block_count, in_blocks

WINDOW = 35
_BASE = 0xA0761D6478BD642F
_SECOND = 0xE7037ED1A0B428DB


def window_starts(words: Words, window: int) -> np.ndarray:
    """The number of the first word of each window that lies in one text."""
    return np.flatnonzero(np.arange(len(words.start)) + window <= words.first[words.doc + 1])


def window_hashes(hashes: np.ndarray, at: np.ndarray, window: int, base: int = _BASE) -> np.ndarray:
    """Rabin-Karp hash of the windows that start at `at`, from differences of prefix sums."""
    up, down = powers(len(hashes) + 1, base)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[at + window] - total[at]) * down[at])


def _send(window: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        found, dealt = [], []
        for batch in slices(table):
            words = Words(batch.column("text"), KEEP)
            hashes, at = words.hashes(), window_starts(words, window)
            h, first = np.unique(window_hashes(hashes, at, window), return_index=True)
            found.append(h)
            dealt.append(window_hashes(hashes, at[first], window, _SECOND) % np.uint64(buckets))
        h, first = np.unique(np.concatenate(found), return_index=True)
        b = np.concatenate(dealt)[first]
        order = np.argsort(b, kind="stable")
        h, b = h[order], b[order]
        names, first = np.unique(b, return_index=True)
        parts = [x.tobytes() for x in np.split(h, first[1:])] if len(names) else []
        block = np.full(len(names), table.column("block")[0].as_py())
        return pa.table({"block": block, "bucket": names.astype(np.int64), "hashes": pa.array(parts, pa.binary())})

    return send


def _repeated(table: pa.Table) -> pa.Table:
    """For each block the hashes of this bucket that another block has too."""
    sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("hashes")]
    everything = np.sort(np.concatenate(sets))
    twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
    parts = [s[np.isin(s, twice, assume_unique=True)].tobytes() for s in sets]
    out = pa.table({"block": table.column("block"), "hashes": pa.array(parts, pa.binary())})
    return out.filter(pa.array([bool(p) for p in parts]))


def repeated_words(words: Words, window: int, repeated: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window whose hash is among the sorted ones given."""
    at = window_starts(words, window)
    h = window_hashes(words.hashes(), at, window)
    edge = np.zeros(len(words.start) + 1, dtype=np.int64)
    if len(repeated) and len(h):
        near = np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)
        hit = at[repeated[near] == h]
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _strip(window: int):
    def strip(docs: pa.Table, sent: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "spans": pa.array([], pa.list_(pa.int64())), "kept": pa.array([], pa.string())})
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in sent.column("hashes")]
        own, inside = [], []
        for batch in slices(docs):
            words = Words(batch.column("text"), KEEP)
            h = np.sort(window_hashes(words.hashes(), window_starts(words, window), window))
            inside.append(np.unique(h[1:][h[1:] == h[:-1]]))
            own.append(np.unique(h))
        own_all = np.sort(np.concatenate(own))
        repeated = np.unique(np.concatenate([*sets, *inside, own_all[1:][own_all[1:] == own_all[:-1]]]))
        out = []
        for batch in slices(docs):
            words = Words(batch.column("text"), KEEP)
            gone = repeated_words(words, window, repeated)
            data, rows = words.buf.tobytes(), len(words.count)
            n_removed = np.bincount(words.doc, weights=gone, minlength=rows).astype(np.int64)
            kept, spans = [], []
            for r in range(rows):
                a, b = words.first[r], words.first[r + 1]
                text = data[words.off[r] : words.off[r + 1]].split()
                cut: list[int] = []
                if n_removed[r]:
                    step = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]])))
                    cut = step.tolist()
                    rest, last = [], 0
                    for i in range(0, len(cut), 2):
                        rest += text[last : cut[i]]
                        last = cut[i + 1]
                    text = rest + text[last:]
                kept.append(b" ".join(text).decode())
                spans.append(cut)
            out.append(pa.table({
                "doc_id": batch.column("doc_id"), "n_words": words.count.astype(np.int64), "n_removed": n_removed,
                "spans": pa.array(spans, pa.list_(pa.int64())), "kept": pa.array(kept, pa.string()),
            }))
        return pa.concat_tables(out)

    return strip


def strip_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start and end words of each removed interval, flat) and kept (text) for each row.

    A word goes if it lies in a window of `window` words whose sequence starts anywhere else as well. Null and empty texts
    have no words; a row given twice repeats itself; texts shorter than the window keep all.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    n = block_count(docs, block_bytes)
    blocks = in_blocks(docs, n)
    buckets = max(n, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))  # so that none grows with the corpus
    sent = blocks.groupBy("block").applyInArrow(_send(window, buckets), "block long, bucket long, hashes binary")
    repeated = sent.groupBy("bucket").applyInArrow(_repeated, "block long, hashes binary")
    schema = f"doc_id {kind}, n_words long, n_removed long, spans array<bigint>, kept string"
    return blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_strip(window), schema)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), v AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), r AS (
  SELECT doc_id, i FROM v JOIN (SELECT t FROM v GROUP BY t HAVING count(*) > 1) USING (t)
), g AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM r) GROUP BY doc_id
), k AS (
  SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS s FROM (SELECT doc_id, w, gone, unnest(range(1, len(w) + 1)) AS i FROM k) WHERE NOT list_contains(gone, i) GROUP BY doc_id
)
SELECT k.doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM k LEFT JOIN kept USING (doc_id)
"""
