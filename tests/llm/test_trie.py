"""Operator 12 against a trie built turn by turn."""

from __future__ import annotations

import hashlib
import math
import random
import tempfile
import zlib
from collections import defaultdict

import pytest

from clickloom.llm.trie import SpillingQueue, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    given = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            given[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(role, text) for *_, role, text in sorted(ts)] for c, ts in given.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids[path]]
        saves = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        totals[path] = (sum(b[0] for b in below) or 1, saves + sum(b[1] for b in below))
    out = []
    for path, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(path))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids[path]), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def conversations(seed, n=60):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, r.choice([t, t, None, 1]), r.choice(["user", None, ""]), r.choice(["yes", "né", "", None, "a" * 50])))
    rows += [(n + 1, t, "user", "same") for t in range(20)] + [(n + 1 + 5 * k, t, "user", "same") for k in range(1, 9) for t in range(20)]
    rows += [(None, 1, "user", "lost"), rows[0], (-7, 1, "user", "below"), (-5, 1, "user", "zero")]
    return rows


@pytest.mark.parametrize(("shard", "queue", "chunk"), [(1 << 16, 1 << 18, 1 << 20), (12, 3, 5), (1, 1, 1)])
def test_trie_is_that_of_brute_force(spark, shard, queue, chunk):
    rows = conversations(5)
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA), shard, queue, chunk)
    assert nodes(got) == sorted(brute(rows), key=repr)


def test_a_conversation_of_many_blocks_and_its_copies(spark):
    rows = [(c, t, "user", f"turn {t % 7}") for c in (0, 5, 10) for t in range(9000 if c else 4500)]
    assert nodes(prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(6), 100, 16)) == sorted(brute(rows), key=repr)


def test_edges(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, None), (1, None, None, None)]
    df = spark.createDataFrame([(*r, 3) for r in rows], SCHEMA + ", depth int")  # a column with a name of the result
    assert nodes(prefix_trie(df)) == sorted(brute(rows), key=repr)
    turnless = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 0, "user", "goes with the first turns")]
    assert nodes(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == sorted(brute(rows), key=repr)


def test_queue_spills_and_sums():
    r, folder = random.Random(1), "file://" + tempfile.mkdtemp(prefix="spark-")
    queue, want = SpillingQueue(folder, 10), defaultdict(lambda: [0, 0])
    for _ in range(500):
        key, sums = (r.randrange(40), r.randrange(5), 0), [r.randrange(9), 1]
        queue.push(key, sums)
        want[key] = [a + b for a, b in zip(want[key], sums, strict=True)]
    assert len(queue.paths) > 1
    assert [queue.pop((a, b, 0), 2) for a in range(40) for b in range(5)] == [want[a, b, 0] for a in range(40) for b in range(5)]
    queue.close()
