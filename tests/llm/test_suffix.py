"""Operator 13 against all windows of all texts, and its sort against sorted()."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import suffix

SCHEMA = "doc_id long, text string, n_bytes int"


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def texts(seed):
    r = random.Random(seed)
    say = lambda n: "".join(r.choice("abé ") for _ in range(n))
    hot = say(60)
    rows = [(i, say(r.randint(0, 120))) for i in range(40)]
    rows += [(100 + i, say(r.randint(0, 20)) + hot[r.randint(0, 5) : 60 - r.randint(0, 5)] + say(r.randint(0, 20))) for i in range(40)]
    rows += [(200, hot), (201, hot), (201, hot), (202, None), (203, ""), (None, hot[3:50]), (204, "a" * 300), (205, "ab" * 40), (206, say(5000) + hot), (207, hot + hot)]
    return rows


@pytest.mark.parametrize(("length", "gram", "bucket_rows", "piece"), [(20, 6, 1 << 15, 1 << 19), (20, 6, 20, 64), (33, 20, 50, 300)])
def test_windows_are_those_of_brute_force(spark, length, gram, bucket_rows, piece):
    rows = texts(length)
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA).repartition(3)  # n_bytes: a column with a name of the result
    got = suffix.digest(suffix.strip_repeats(df, length, gram, bucket_rows, piece))
    assert rows_of(got) == brute(rows, length)


def test_contract_length_and_spans(spark):
    r = random.Random(2)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = say(700)
    rows = [(1, say(900) + passage + say(300)), (2, passage[:650] + say(100)), (3, say(50) + passage[100:499] + say(20)), (4, say(2000))]
    found = suffix.strip_repeats(spark.createDataFrame([(*x, 0) for x in rows], SCHEMA))
    assert {x.doc_id: x.spans for x in found.collect()} == {1: [900, 1550], 2: [0, 650], 3: [], 4: []}
    assert rows_of(suffix.digest(found)) == brute(rows, 400)


def test_empty_table(spark):
    assert suffix.digest(suffix.strip_repeats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_sort_and_prefixes():
    r = np.random.default_rng(1)
    rows = r.integers(97, 99, (500, 21), dtype=np.uint8)
    rows[100:140] = rows[0]
    order = suffix.multikey_sort(rows)
    assert [bytes(x) for x in rows[order]] == sorted(bytes(x) for x in rows)
    want = [next((k for k in range(21) if a[k] != b[k]), 21) for a, b in zip(rows[order[:-1]], rows[order[1:]], strict=True)]
    assert suffix.common_prefix(rows, order).tolist() == [0, *want]
