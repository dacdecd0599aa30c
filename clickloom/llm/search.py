"""Operator 11: exact ranked search by posting lists in geometric blocks.

Texts become vectors of the query terms' impacts (term weight times saturated frequency, in integers). Rows are
range-partitioned by a similarity sketch (signs of random projections), so that like texts stand together, and cut into
shards of bounded size. A shard indexes all of its rows: each term's posting list is cut into blocks of documents that
stand together, and each block stores the coordinatewise maximum of its documents' vectors, over the terms that meet the
list's term in a query. Lists that hold much of a shard use one cutting of the whole shard, as they are nearly that.

A query takes its terms from the greatest impact down. A block is skipped only if its summary, summed over the query's
terms, is below the score that a document must reach; the rest of the lists goes when even all of their greatest impacts
together are. That score starts from the tenth best of a bounded sample of rows and rises with what a shard finds. It
never exceeds the true tenth best score, so nothing is lost. The best of each shard are merged by Spark.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import KEEP, Words, raw, slices
from .store import Scratch

TOP, SAMPLE = 10, 4096
CELLS = 1 << 22  # documents times terms of a shard, which bounds its memory
QUERY_TERMS = 1 << 18  # distinct terms of the items that are searched for at once
RUN, BLOCK, OFTEN = 64, 16, 16  # documents of a block of a shard, and of a short list; a list is long from 1 / OFTEN of a shard
NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BITS = 16
_NULL = -(1 << 63)  # stands for a null doc_id

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def terms_of(text: pa.StringArray) -> Words:
    """The terms of a slice of texts: letters, digits and all that isn't ASCII, A-Z lowered."""
    data, off = raw(text)
    return Words.of(_FOLD[data], off, _TERM[data])


def term_hashes(terms: list[str]) -> np.ndarray:
    if not terms:
        return np.empty(0, dtype=np.uint64)
    return Words(pa.array(terms, pa.string()), KEEP).hashes()


def _count(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """id, n (terms), terms (numbers of query terms) and tf of each text, and its similarity sketch."""
        known = np.frombuffer(vocabulary.value, dtype=np.uint64)
        signs = np.random.default_rng(11).choice(np.array([-1, 1], dtype=np.int8), (len(known), _BITS))
        for whole in batches:
            for batch in slices(whole):
                words = terms_of(batch.column("text"))
                h = words.hashes()
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[at] == h if len(known) else np.zeros(len(h), dtype=bool)
                cell, tf = np.unique(words.doc[hit].astype(np.int64) << 32 | at[hit], return_counts=True)
                row, term = cell >> 32, cell & 0xFFFFFFFF
                first = np.searchsorted(row, np.arange(batch.num_rows + 1))
                sums = np.concatenate([np.zeros((1, _BITS), np.int64), np.cumsum(signs[term], axis=0, dtype=np.int64)]) if len(known) else np.zeros((1, _BITS), np.int64)
                sketch = ((sums[first[1:]] - sums[first[:-1]] > 0) << np.arange(_BITS)).sum(axis=1)
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (term, tf)]
                yield pa.record_batch([batch.column("id"), pa.array(words.count, pa.int64()), *lists, pa.array(sketch, pa.int32())], ["id", "n", "terms", "tf", "sketch"])

    return count


class Shard:
    """An index over some documents. impact: a row for each, a column for each term; together: for each term, the terms that meet it in a query."""

    def __init__(self, ids: np.ndarray, impact: np.ndarray, together: list[np.ndarray]):
        self.ids, self.impact = ids, impact
        self.most = impact.max(axis=0) if len(ids) else np.zeros(impact.shape[1], np.int64)
        runs = np.arange(0, len(ids), RUN)
        self.whole = runs, np.maximum.reduceat(impact, runs, axis=0)
        self.lists: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None] = [None] * impact.shape[1]
        row, term = np.nonzero(impact)
        by = np.argsort(term, kind="stable")
        row, term = row[by], term[by]
        names, first = np.unique(term, return_index=True)
        for t, docs in zip(names.tolist(), np.split(row, first[1:]) if len(names) else [], strict=True):
            if OFTEN * len(docs) < len(ids):
                starts = np.arange(0, len(docs), BLOCK)
                self.lists[t] = docs, starts, together[t], np.maximum.reduceat(impact[np.ix_(docs, together[t])], starts, axis=0)

    def blocks(self, term: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents of a term's list, where its blocks begin, and each block's bound for the query."""
        mine = self.lists[term]
        if mine is None:
            docs = np.flatnonzero(self.impact[:, term])
            starts = np.searchsorted(docs, self.whole[0])
            used = np.append(starts[1:], len(docs)) > starts  # runs without the term have no block in its list
            return docs, starts[used], self.whole[1][used][:, query].sum(axis=1)
        docs, starts, coordinates, most = mine
        return docs, starts, most[:, np.searchsorted(coordinates, query)].sum(axis=1)

    def search(self, query: np.ndarray, top: int, reach: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the query's best, of which none below `reach` need be told; and how many documents were scored."""
        query = query[np.argsort(-self.most[query], kind="stable")]
        query = query[self.most[query] > 0]
        rest = np.cumsum(self.most[query][::-1])[::-1]
        ordered = np.sort(query)
        seen, docs, scores = np.zeros(len(self.ids), dtype=bool), [], np.empty(0, dtype=np.int64)
        for term, left in zip(query.tolist(), rest.tolist(), strict=True):
            if left < reach:
                break
            postings, starts, bound = self.blocks(term, ordered)
            passes = np.repeat(bound >= reach, np.diff(np.append(starts, len(postings))))
            new = postings[passes]
            new = new[~seen[new]]
            if not len(new):
                continue
            seen[new] = True
            docs.append(new)
            scores = np.append(scores, self.impact[np.ix_(new, ordered)].sum(axis=1))
            if len(scores) >= top:
                reach = max(reach, int(np.partition(scores, -top)[-top]))
        found = np.concatenate(docs) if docs else np.empty(0, dtype=np.int64)
        order = np.lexsort((self.ids[found], -scores))[:top]
        order = order[scores[order] >= max(reach, 1)]
        return found[order], scores[order], len(found)


def _search(given, cells: int, top: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """item (number), id, score and the documents scored, of the best of each shard."""
        weight, queries, reach, n_docs, n_terms = given.value
        meet: list[set[int]] = [set() for _ in weight]
        for q in queries:
            for t in q.tolist():
                meet[t].update(q.tolist())
        together = [np.array(sorted(m), dtype=np.int64) for m in meet]
        rows = max(RUN, cells // max(len(weight), 1))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                n, ids = part.column("n").to_numpy(), part.column("id").to_numpy(zero_copy_only=False)
                lists = part.column("terms"), part.column("tf")
                term, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
                row = np.repeat(np.arange(part.num_rows), np.diff(lists[0].offsets.to_numpy()))
                m = 10 + 90 * n * n_docs // n_terms
                impact = np.zeros((part.num_rows, len(weight)), dtype=np.int64)
                impact[row, term] = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                shard = Shard(ids, impact, together)
                out = [(i, *shard.search(q, top, r)) for i, (q, r) in enumerate(zip(queries, reach, strict=True))]
                counts = [len(x[1]) for x in out]
                if sum(counts):
                    best = np.concatenate([x[1] for x in out])
                    scored = np.repeat([x[3] for x in out], counts)
                    yield pa.record_batch([pa.array(np.repeat([x[0] for x in out], counts)), part.column("id").take(pa.array(best)), pa.array(np.concatenate([x[2] for x in out])), pa.array(scored)], ["item", "id", "score", "scored"])

    return search


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def _items(bench: DataFrame) -> DataFrame:
    """item_id and the distinct terms of each item that has some; rows of one id are one item."""
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    each = bench.select("item_id", F.explode(F.array_remove(F.split(low, NOT_TERM), "")).alias("term"))
    return each.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def ranked(docs: DataFrame, bench: DataFrame, top: int = TOP, cells: int = CELLS, query_terms: int = QUERY_TERMS, sample: int = SAMPLE) -> DataFrame:
    """item_id, rank, doc_id, score of the `top` best documents with a score above 0 of each item, equal scores by ascending doc_id.

    Null texts and items have no terms and find nothing; rows of one item_id are one item, rows of one doc_id are ranked
    each (a null doc_id first among equals). Items with more than `query_terms` distinct terms in all are searched for in
    several passes over the texts. Only the items' terms are indexed, from every row; counts are those of all texts.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("id"), F.col("text").cast("string").alias("text"))
    items = scratch.settled(_items(bench))
    passes = math.ceil((items.agg(F.sum(F.size("terms"))).first()[0] or 0) / query_terms)
    kind = bench.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    out = None
    for k in range(passes):
        some = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k).collect()  # about query_terms terms
        found = _pass(rows, some, top, cells, sample, scratch)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(some)], f"item long, item_id {kind}")
        best = Window.partitionBy("item").orderBy(F.desc("score"), "id")
        found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
        one = found.join(F.broadcast(names), "item").select("item_id", "rank", F.when(F.col("id") != _NULL, F.col("id")).alias("doc_id"), "score")
        out = one if out is None else out.union(one)
    return out if out is not None else spark.createDataFrame([], schema)


def _pass(rows: DataFrame, items: list, top: int, cells: int, sample: int, scratch: Scratch) -> DataFrame:
    spark = rows.sparkSession
    words = sorted({t for r in items for t in r.terms})
    hashes = term_hashes(words)
    order = np.argsort(hashes)
    place = {words[i]: k for k, i in enumerate(order.tolist())}
    vocabulary = spark.sparkContext.broadcast(hashes[order].tobytes())  # 8 bytes a term
    counted = scratch.settled(rows.select("id", "text").mapInArrow(_count(vocabulary), "id long, n long, terms array<int>, tf array<int>, sketch int").filter("n > 0"))
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(words), dtype=np.int64)
    for t, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each query term
        df[t] = n
    queries = [np.sort(np.array([place[t] for t in r.terms], dtype=np.int64)) for r in items]
    queries = [q[df[q] > 0] for q in queries]
    counted = counted.filter("size(terms) > 0")
    have = "item long, id long, score long, scored long"

    def search(part: DataFrame, reach: list[int]) -> DataFrame:
        given = spark.sparkContext.broadcast((weights(df, n_docs), queries, reach, n_docs, n_terms or 1))
        return part.select("id", "n", "terms", "tf").mapInArrow(_search(given, cells, top), have)

    best = search(counted.limit(sample), [0] * len(items))
    place_of = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    reach = [0] * len(items)
    for r in best.withColumn("place", place_of).filter(F.col("place") == top).select("item", "score").collect():  # a row an item at most
        reach[r.item] = r.score
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    alike = counted.repartitionByRange(parts, "sketch", "id").sortWithinPartitions("sketch", "id")
    return scratch.settled(search(alike, reach))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), s AS (
  SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0
), p AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL
), v AS (
  SELECT t, floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY t
), r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * p.n * s.n) // s.l))))::BIGINT AS score FROM q JOIN p USING (t) JOIN v USING (t), s GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r WHERE score > 0 QUALIFY rank <= 10
"""
