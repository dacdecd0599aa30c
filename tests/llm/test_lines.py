"""Line removal against all pairs: any kind of id, repeated rows, frequent words and split groups."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import lines


def crowded(seed, n=200):
    r = random.Random(seed)
    core = [f"c{i}" for i in range(14)]
    return [" ".join([*(f"v{r.randrange(30)}" if r.random() < 0.12 else w for w in core), *(f"w{r.randrange(30)}" for _ in range(r.randint(0, 2)))]) for _ in range(n)]


def gone(sets, percent=80):
    """Numbers of the sets that an earlier one equals or resembles."""
    return [i for i, s in enumerate(sets) if s and any(100 * len(s & x) >= percent * len(s | x) for x in sets[:i])]


@pytest.mark.parametrize(("kind", "limits"), [("string", {}), ("negative", {"hot": 4, "block": 16}), ("huge", {"hot": 40}), ("one text", {"hot": 1, "block": 7})])
def test_every_similar_line_is_found(spark, kind, limits):
    rows = crowded(len(kind))
    want = gone([frozenset(x.split()) for x in rows])
    if kind == "one text":
        found = lines.dedup_lines(spark.createDataFrame([(1, "\n".join(rows))], "doc_id long, text string"), **limits).collect()
        assert found[0].lines.gone == want
        return
    ids = {"string": [f"k{i:05d}" for i in range(len(rows))], "negative": range(-len(rows), 0), "huge": range(1 << 60, (1 << 60) + len(rows))}[kind]
    d = list(zip(ids, rows, strict=True))
    random.Random(0).shuffle(d)
    found = lines.dedup_lines(spark.createDataFrame(d, f"doc_id {'string' if kind == 'string' else 'long'}, text string").repartition(5), **limits).collect()
    place = {k: i for i, k in enumerate(ids)}
    assert sorted(place[x.doc_id] for x in found if x.lines.gone == [0]) == want and all(x.lines.gone in ([], [0]) for x in found)


def test_repeated_rows(spark):
    """Rows of equal id and text are one document; texts of one id are told apart."""
    a, b = "one two three four five", "six seven eight nine ten"
    d = spark.createDataFrame([(1, a), (1, a), (1, b), (2, f"{b}\n{a} more\n\nnew"), (2, None), (None, b), (3, ""), (3, "")], "doc_id long, text string")
    found = sorted((x.doc_id or 0, x.text or "", tuple(x.lines.gone), x.lines.text) for x in lines.dedup_lines(d).collect())
    assert found == [(0, b, (), b), (1, a, (), a), (1, a, (), a), (1, b, (0,), ""), (2, "", (), None), (2, f"{b}\n{a} more\n\nnew", (0, 1), "\nnew"), (3, "", (), ""), (3, "", (), "")]


def test_low_similarity_and_tiny_sets(spark):
    r = random.Random(4)
    rows = [" ".join(r.sample("abcdefgh", r.randint(1, 4))) for _ in range(60)]
    for percent in (50, 60, 100):
        found = lines.dedup_lines(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), percent=percent, hot=2).collect()
        assert sorted(x.doc_id for x in found if x.lines.gone) == gone([frozenset(x.split()) for x in rows], percent)


def test_lines_of_a_template_that_cannot_be_similar_never_meet():
    """Under the key of a frequent pair: 40,000 lines of five words, of which one is their own."""
    for many in (10_000, 40_000):
        n, at, group = np.full(many, 5), np.full(many, 1), np.zeros(many, dtype=np.int64)
        assert list(lines._ranges(group, n, at, 80)) == []
    r = np.random.default_rng(2)
    group, n = np.sort(r.integers(0, 6, 300)), r.integers(1, 12, 300)
    at = r.integers(0, 4, 300) % n
    order = np.lexsort((at, n, group))
    n, at = n[order], at[order]
    met = {(int(i), int(j)) for x, a, b in lines._ranges(group, n, at, 80) for i, s, e in zip(x, a, b, strict=True) for j in range(s, e)}
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if group[i] == group[j] and 100 * n[i] >= 80 * n[j] and 180 * min(n[i] - at[i], n[j] - at[j]) >= 80 * (n[i] + n[j])}
    assert met == want


def test_time_of_template_lines_is_linear(spark):
    took = []
    for many in (15_000, 60_000):
        docs = spark.range(many).select(F.col("id").alias("doc_id"), F.concat(F.lit("user "), F.sha1(F.col("id").cast("string")), F.lit(" liked this post")).alias("text")).repartition(4)
        began = time.time()
        assert lines.dedup_lines(docs, hot=1000).agg(F.sum(F.size("lines.gone"))).first()[0] == 0
        took.append(time.time() - began)
    assert took[1] < 5 * took[0]
