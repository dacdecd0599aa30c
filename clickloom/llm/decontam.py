"""Operator 6: benchmark passages found in training texts, with DataFrame functions only.

The benchmark's distinct windows of 13 words (shorter items are one window each) form a hash set that is broadcast when
its words and item ids take at most MAX_BROADCAST bytes and joined by shuffle beyond. Each text's windows are hashed in one array expression
and looked up; hits are verified word by word on the text. Documents without a hit are never regrouped by window.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

WINDOW, PERCENT = 13, 5
MAX_BROADCAST = 128 << 20  # bytes of windows, or of hits, that are broadcast
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str | Column) -> Column:
    """The words of a text, A-Z lowered; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, NOT_WORD), "")


def _bytes(strings: str | Column) -> Column:
    """What an array of strings takes in a row, from above."""
    return F.aggregate(strings, F.lit(24).cast("long"), lambda n, s: n + 16 + F.octet_length(s))


def benchmark_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """size, hash, passage, items: each distinct window with the items (as strings) that hold it; items without id hit as well, unnamed."""
    items = bench.select(F.col("item_id").cast("string").alias("item"), words_of("text").alias("words")).filter("size(words) > 0")
    items = items.withColumn("size", F.least(F.size("words"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    cut = items.select("item", "size", "words", starts.alias("at")).select("item", "size", F.slice("words", F.col("at"), F.col("size")).alias("passage"))
    return cut.groupBy("size", "passage").agg(F.collect_set("item").alias("items")).withColumn("hash", F.xxhash64("size", "passage"))


def _window_hashes(size: int) -> Column:
    starts = F.when(F.size("words") >= size, F.sequence(F.lit(1), F.size("words") - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(size), F.slice("words", i, F.lit(size))))


def _hits(docs: DataFrame, bench: DataFrame, window: int, limit: int) -> DataFrame:
    """row, hits: for each text with hash hits, where they start and what must stand there."""
    found = benchmark_windows(bench, window)
    sizes = found.groupBy("size").agg(F.sum(_bytes("passage") + _bytes("items") + 40)).collect()  # at most `window` rows
    if not sizes:
        return docs.sparkSession.createDataFrame([], "row long, hits array<struct<at:int,size:int,passage:array<string>,items:array<string>>>")
    texts = docs.select("row", words_of("text").alias("words"))
    each = []
    for size, _ in sizes:
        each.append(texts.select("row", F.posexplode(_window_hashes(size)).alias("at", "hash"), F.lit(size).alias("size")))
    windows = each[0]
    for more in each[1:]:
        windows = windows.union(more)
    small = sum(n for _, n in sizes) <= limit
    hit = windows.join(F.broadcast(found) if small else found, ["size", "hash"])
    return hit.groupBy("row").agg(F.collect_set(F.struct((F.col("at") + 1).alias("at"), "size", "passage", "items")).alias("hits"))


def scan(docs: DataFrame, bench: DataFrame, window: int = WINDOW, percent: int = PERCENT, column: str = "decontam", limit: int = MAX_BROADCAST) -> DataFrame:
    """docs with a struct column (`decontam`, or another name that docs lacks): words, hit (word numbers, from 1), items (sorted), contaminated.

    A text is contaminated if some words are hit and they are at least `percent` of its words. Null and empty texts and
    an empty benchmark give no hits; repeated rows are judged each; items without id hit but aren't among `items`.
    """
    docs = docs.select(F.struct("*").alias("given"), "text", F.xxhash64("doc_id", "text").alias("row"))
    scratch = Scratch(docs.sparkSession)
    hits = scratch.settled(_hits(docs.select("row", "text"), bench, window, limit))
    found = hits.agg(F.sum(F.aggregate("hits", F.lit(40).cast("long"), lambda n, h: n + 40 + _bytes(h["passage"]) + _bytes(h["items"])))).first()[0] or 0
    joined = docs.join(F.broadcast(hits) if found <= limit else hits, "row", "left")  # few hits: texts aren't shuffled
    words = words_of("text")
    true = F.filter("hits", lambda h: F.slice("words", h["at"], h["size"]) == h["passage"])
    out = joined.withColumn("words", words).withColumn("hits", F.coalesce(true, F.array().cast(joined.schema["hits"].dataType)))
    hit = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    bad = (F.size("hit") > 0) & (100 * F.size("hit") >= percent * F.size("words"))
    out = out.withColumn("hit", hit).withColumn("items", items)
    return out.select("given.*", F.struct("words", "hit", "items", bad.alias("contaminated")).alias(column))


def free_name(docs: DataFrame, name: str) -> str:
    """name, or name with underscores until docs has no such column."""
    while name in docs.columns:
        name += "_"
    return name


def clean_documents(docs: DataFrame, bench: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that are not contaminated."""
    column = free_name(docs, "decontam")
    return scan(docs, bench, window, percent, column).filter(~F.col(f"{column}.contaminated")).drop(column)


def clean_spans(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the hit words of each text left out; a text that had hits becomes its other words, joined by spaces."""
    column = free_name(docs, "decontam")
    found = scan(docs, bench, window, column=column)
    words, hit = F.col(f"{column}.words"), F.col(f"{column}.hit")
    rest = F.array_except(F.sequence(F.lit(1), F.size(words)), hit)
    text = F.when(F.size(hit) == 0, F.col("text")).otherwise(F.array_join(F.transform(rest, lambda i: F.get(words, i - 1)), " "))
    return found.withColumn("text", text).drop(column)


def digest(found: DataFrame) -> DataFrame:
    d = "decontam."
    return found.select(
        "doc_id", F.size(d + "words").cast("long").alias("n_words"), F.size(d + "hit").cast("long").alias("n_hit"),
        F.size(d + "items").cast("long").alias("n_items"), F.sha2(F.array_join(d + "items", ",").cast("binary"), 256).alias("items_sha256"),
        F.col(d + "contaminated").alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), bi AS (
  SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM bi
), di AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n
), h AS (
  SELECT doc_id, i, bw.n, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM di) x JOIN bw ON x.t = bw.t AND x.n = bw.n
), p AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS q FROM h) GROUP BY doc_id
), m AS (
  SELECT doc_id, count(item) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""
