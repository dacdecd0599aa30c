"""Operator 11 against the scores of all documents."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from clickloom.llm import search
from clickloom.llm.search import Shard, ranked

DOCS, BENCH = "doc_id long, text string, score int", "item_id string, text string, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, top=10):
    vectors = [(i, terms(t)) for i, t in docs]
    held = [v for v in vectors if v[1]]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, words in held:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    items = {}
    for item, text in bench:
        items.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in items.items():
        scored = []
        for i, words in held:
            m = 10 + 90 * len(words) * n_docs // n_terms
            s = 0
            for w in query:
                tf = words.count(w)
                if tf:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def tables(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "日本", "ÉTÉ", "X9"]
    say = lambda n: " ".join(r.choice(vocabulary[: r.choice([8, 64])]) + r.choice(["", ",", "-B"]) for _ in range(n))
    docs = [(i, say(r.randint(0, 40))) for i in range(300)]
    docs += [(300 + i, docs[3][1]) for i in range(50)] + [docs[5], docs[5], (None, docs[3][1]), (400, None), (401, ""), (402, "- -"), (403, say(20000)), (404, "a" * 300000)]
    bench = [(f"b{i}", say(r.randint(1, 12))) for i in range(20)] + [("b3", "W1 w2"), ("none", None), ("", "absent words"), (None, "w5 x9"), ("copy", docs[3][1])]
    return docs, bench


@pytest.mark.parametrize(("cells", "query_terms", "sample"), [(1 << 22, 1 << 18, 4096), (64 * 70, 1 << 18, 7), (1, 40, 1)])
def test_best_are_those_of_all_documents(spark, cells, query_terms, sample):
    docs, bench = tables(cells)
    got = ranked(spark.createDataFrame([(*d, 1) for d in docs], DOCS).repartition(3), spark.createDataFrame([(*b, 1) for b in bench], BENCH), cells=cells, query_terms=query_terms, sample=sample)
    assert sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in got.collect()), key=repr) == brute(docs, bench)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b", 0)], DOCS), spark.createDataFrame([("x", "a b", 0)], BENCH)
    assert ranked(docs, bench.limit(0)).count() == 0
    assert ranked(docs.limit(0), bench).count() == 0
    assert ranked(docs, bench).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_are_skipped_only_below_the_bound():
    r = np.random.default_rng(4)
    impact = np.where(r.random((900, 40)) < 0.1, r.integers(1, 1000, (900, 40)), 0)
    impact[:, 0] = r.integers(1, 20, 900)
    impact[100:116] *= 5
    shard = Shard(np.arange(900), impact, [np.arange(40)] * 40)
    fewer = 0
    for k in range(1, 30):
        query = np.array([0, k, k + 3, k + 7])
        want = sorted(((-int(s), i) for i, s in enumerate(impact[:, query].sum(axis=1))))[:10]
        docs, scores, scored = shard.search(query, 10, 0)
        assert [(-s, d) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)] == want
        for block in range(len(shard.blocks(k, query)[1])):
            members, starts, bound = shard.blocks(k, query)
            inside = members[starts[block] : starts[block + 1] if block + 1 < len(starts) else None]
            assert bound[block] >= impact[np.ix_(inside, query)].sum(axis=1).max()
        fewer += scored < 450
    assert fewer > 20


def test_weights():
    assert search.weights(np.array([1, 4]), 4).tolist() == [math.floor(1000 * math.log(10 / 3)), math.floor(1000 * math.log(10 / 9))]
