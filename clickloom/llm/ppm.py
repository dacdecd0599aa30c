"""Operator 1: language-model scores by prediction by partial matching over bytes.

A text is read as its bytes (A-Z lowered, white space as it is) and an end sign that no text holds; contexts before its
start are newlines. Contexts of 5 to 0 bytes form the trie. A context with n occurrences and u distinct followers gives a
follower seen c times c / (n + u) and keeps u / (n + u) as escape (method C); after an escape the followers of the
longer context are excluded from the shorter one, and below order 0 the bytes not excluded are equally likely.

Pretrained scoring, for any corpus size: texts are dealt into blocks; each block names the distinct words and 6-byte
grams it holds with their training counts, packed for each bucket. A bucket sums the counts of all blocks and turns
grams into log-probabilities: grams sharing their last two context bytes share a bucket, so their contexts of two bytes
and more are there too. Orders 1 and 0 come from the counts of byte pairs in all training texts, 65,536 at most, which
every bucket gets. What a block asked for goes back to it, and the block scores its texts. There are as many buckets as
blocks, so that neither grows with the corpus; only counts and a block's own vocabulary move, and no table of the whole
model exists in one place.

Words are compared by 63-bit hashes of their bytes. Null texts are empty: one end token, one end sign.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import KEEP, SPACE, Words, mix, slices
from .blocks import block_count, in_blocks

ORDER, SHARED = 5, 2  # the longest context; that which all grams of a bucket share
PPM_BLOCK_BYTES = 16 << 20
LEAD, END = 10, 255
_TOP = np.uint64(1 << 63)
END_KEY = -(1 << 63)  # the end token, among the word keys (all negative)


def normal(text: str | None) -> bytes:
    """The bytes that are coded for a text, without the leading context."""
    return (text or "").encode().lower() + bytes([END])


class Trie:
    """Byte-context trie with counts, for adaptive code lengths and as the plain form of the pretrained model."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.followers: dict[bytes, dict[int, int]] = defaultdict(lambda: defaultdict(int))

    def add(self, context: bytes, symbol: int) -> None:
        for k in range(self.order + 1):
            self.followers[context[len(context) - k :]][symbol] += 1

    def log10(self, context: bytes, symbol: int) -> float:
        out, gone = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.followers.get(context[len(context) - k :])
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in gone}
            total = sum(left.values()) + len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / total)
            if total:
                out += math.log10(len(left) / total)
            gone |= set(seen)
        return out - math.log10(256 - len(gone))

    def text(self, text: str | None, learn: bool = False) -> float:
        """log10 probability of a text; learn: the trie grows after each byte (adaptive coding)."""
        out, data = 0.0, bytes([LEAD]) * self.order + normal(text)
        for i in range(self.order, len(data)):
            context, symbol = data[i - self.order : i], data[i]
            out += self.log10(context, symbol)
            if learn:
                self.add(context, symbol)
        return out


def adaptive_scores(docs: DataFrame) -> DataFrame:
    """doc_id, score: code length (log10) of each text by a trie that starts empty and learns from that text alone."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [Trie().text(t, learn=True) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each after its leading context, and their offsets."""
    lead = bytes([LEAD]) * ORDER
    parts = [lead + normal(t) for t in texts]
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _grams(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The gram (context and byte) that ends at each coded byte, in order; all texts hold a byte at least."""
    g = np.zeros(len(buf), dtype=np.int64)
    for k in range(ORDER + 1):
        g[ORDER:] = (g[ORDER:] << 8) | buf[k : len(buf) - ORDER + k]
    coded = np.ones(len(buf), dtype=bool)
    for k in range(ORDER):
        coded[off[:-1] + k] = False
    return g[coded]


def _word_keys(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, Words]:
    words = Words.of(buf, off, (KEEP[buf] != SPACE) & (buf != END))
    return (words.hashes() | _TOP).view(np.int64), words


def _held(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Words by their hash, grams by their last two context bytes."""
    return (mix(np.where(key < 0, key, (key >> 8) & 0xFFFF).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _vocabulary(buckets: int):
    def vocabulary(table: pa.Table) -> pa.Table:
        """Distinct keys of a block with their counts in its training texts, packed by bucket."""
        keys, counts, ends = [], [], 0
        for batch in slices(table, 2 << 20):
            held, texts = _held(batch), batch.column("text").to_pylist()
            ends += int((~held).sum())
            for part in (False, True):
                if not (chosen := [t for t, h in zip(texts, held, strict=True) if h == part]):
                    continue
                buf, off = _coded(chosen)
                for found in (_grams(buf, off), _word_keys(buf, off)[0]):
                    k, c = np.unique(found, return_counts=True)
                    keys.append(k)
                    counts.append(c * (not part))
        keys.append(np.array([END_KEY]))
        counts.append(np.array([ends]))
        k, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate(counts)).astype(np.uint32)
        b = _bucket(k, buckets)
        order = np.argsort(b, kind="stable")
        names, first = np.unique(b[order], return_index=True)
        packed = [[x.tobytes() for x in np.split(v[order], first[1:])] for v in (k, n)]
        block = np.full(len(names), table.column("block")[0].as_py())
        return pa.table({"block": block, "bucket": names, "keys": pa.array(packed[0], pa.binary()), "counts": pa.array(packed[1], pa.binary())})

    return vocabulary


def _totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a bucket, their counts over all blocks, each asked key's place in them, and keys asked by row."""
    asked = [np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column("keys")]
    counts = [np.frombuffer(x.as_py(), dtype=np.uint32) for x in table.column("counts")]
    k, back = np.unique(np.concatenate(asked), return_inverse=True)
    return k, np.bincount(back, weights=np.concatenate(counts)), back, np.cumsum([len(x) for x in asked])


def _answer(pairs: np.ndarray):
    def answer(table: pa.Table) -> pa.Table:
        """What each block asked for: a word's count, a gram's log10 probability."""
        k, c, back, ends = _totals(table)
        value, gram = c, k >= 0
        if gram.any():
            value[gram] = predicted(k[gram], c[gram], pairs)
        values = [x.tobytes() for x in np.split(value[back], ends[:-1])]
        return pa.table({"block": table.column("block"), "keys": table.column("keys"), "vals": pa.array(values, pa.binary())})

    return answer


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, dtype=np.int64)
    for whole in batches:
        for batch in slices(whole, 2 << 20):
            total += np.bincount(_grams(*_coded(batch.column("text").to_pylist())) & 0xFFFF, minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["pair", "n"])


def pair_counts(training: DataFrame) -> np.ndarray:
    """How often each byte (column) was coded after each byte (row) in all training texts; 65,536 numbers at any size."""
    out = np.zeros(1 << 16)
    for r in training.select("text").mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r.pair] = r.n
    return out.reshape(256, 256)


def _size(table: pa.Table) -> pa.Table:
    k, c, _, _ = _totals(table)
    return pa.table({"tokens": [int(c[k < 0].sum())], "kinds": [int((c[k < 0] > 0).sum())]})


def _under(pairs: np.ndarray) -> np.ndarray:
    """The probability of each byte (column) once the context of one byte (row) has escaped."""
    single, seen = pairs.sum(axis=0), pairs > 0
    kinds = (single > 0).sum()
    if not kinds:
        return np.full(pairs.shape, 1 / 256)
    left = kinds - seen.sum(axis=1, keepdims=True)
    total = single.sum() - seen @ single[:, None] + left
    total_safe = np.where(total > 0, total, 1.0)
    return np.where(single > 0, single / total_safe, np.where(total > 0, left / total_safe, 1.0) / max(256 - kinds, 1))


def predicted(gram: np.ndarray, count: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's last byte after the bytes before it.

    gram: all distinct grams with the same last two context bytes; count: their training counts, 0 if only asked for;
    pairs: the counts of all byte pairs.
    """
    # what is left after an escape, as a probability; grown from short to long contexts
    below = _under(pairs).ravel()
    shorter = (np.arange(1 << 16), pairs.ravel(), np.repeat(pairs.sum(axis=1), 256), np.repeat((pairs > 0).sum(axis=1), 256))
    for k in range(SHARED, ORDER + 1):
        mask = (1 << (8 * (k + 1))) - 1
        g, at = np.unique(gram & mask, return_inverse=True)
        c = np.bincount(at, weights=count, minlength=len(g))
        ctx, node = np.unique(g >> 8, return_inverse=True)
        seen = c > 0
        n = np.bincount(node, weights=c, minlength=len(ctx))
        u = np.bincount(node, weights=seen, minlength=len(ctx))
        g0, c0, n0, u0 = shorter
        up = np.searchsorted(g0, g & (mask >> 8))
        gone = np.bincount(node, weights=np.where(seen, c0[up], 0.0), minlength=len(ctx))
        left_u = u0[up] - u[node]
        total = n0[up] - gone[node] + left_u
        total_safe = np.where(total > 0, total, 1.0)
        share = np.where(c0[up] > 0, c0[up] / total_safe, np.where(total > 0, left_u / total_safe, 1.0) * below[up])
        # a context never seen is passed over without an escape
        escaped = np.where(n0[up] > 0, share, below[up])
        below, shorter = escaped, (g, c, n[node], u[node])
    g, c, n, u = shorter
    total = np.where(n > 0, n + u, 1.0)
    p = np.where(c > 0, c / total, np.where(n > 0, u / total, 1.0) * below)
    with np.errstate(divide="ignore"):
        return np.log10(p)[np.searchsorted(g, gram)]


def _score(docs: pa.Table, known: pa.Table) -> pa.Table:
    """n_tokens, n_known, the sum of log10(c + 0.1) and the model's score of each text of a block."""
    if not docs.num_rows:
        none = pa.array([], pa.int64())
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": none, "n_known": none, "logs": none.cast(pa.float64()), "score": none.cast(pa.float64())})
    index = pd.Index(np.frombuffer(b"".join(x.as_py() for x in known.column("keys")), dtype=np.int64))
    value = np.frombuffer(b"".join(x.as_py() for x in known.column("vals")), dtype=np.float64)
    end_count = value[index.get_indexer(np.array([END_KEY]))[0]]
    out = []
    for batch in slices(docs, 2 << 20):
        buf, off = _coded(batch.column("text").to_pylist())
        logp = value[index.get_indexer(_grams(buf, off))]
        score = np.add.reduceat(logp, off[:-1] - ORDER * np.arange(len(off) - 1))
        wkeys, words = _word_keys(buf, off)
        c = value[index.get_indexer(wkeys)]
        rows = len(off) - 1
        n_known = np.bincount(words.doc, weights=c > 0, minlength=rows) + (end_count > 0)
        logs = np.bincount(words.doc, weights=np.log10(c + 0.1), minlength=rows) + math.log10(end_count + 0.1)
        out.append(pa.table({
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": words.count + 1,
            "n_known": n_known.astype(np.int64), "logs": logs, "score": score,
        }))
    return pa.concat_tables(out)


def lm_scores(docs: DataFrame, folds: int = 10, block_bytes: int = PPM_BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    Rows with crc32(doc_id) mod `folds` = 0 are held out; the others train. score: log10 probability of the text by
    the byte trie. base_score: by single words with 0.1 added to each count. A null id counts as the empty string.
    Repeated rows are scored each; an empty table gives no rows.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == 0
    n = block_count(docs, block_bytes)
    blocks = in_blocks(docs, n).withColumn("held_out", held)
    buckets = max(n, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = pair_counts(docs.filter(~held).select(F.col("text").cast("string").alias("text")))
    asked = blocks.groupBy("block").applyInArrow(_vocabulary(buckets), "block long, bucket long, keys binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer(pairs), "block long, keys binary, vals binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double")
    size = asked.groupBy("bucket").applyInArrow(_size, "tokens long, kinds long").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds"))
    tokens, distinct = (F.coalesce(size.select(c).scalar(), F.lit(0)) for c in ("tokens", "kinds"))
    base = F.col("logs") - F.col("n_tokens") * F.log10(tokens + 0.1 * (distinct + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", tokens.cast("long").alias("train_tokens"), base.alias("base_score"), "score")
