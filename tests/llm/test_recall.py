"""Near copies close to the threshold, against all pairs; rows that stages of the pipeline must bear."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
from clickloom.llm import neardup


def _shingles(text: str) -> set[tuple[str, ...]]:
    w = text.lower().split()
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} or {tuple(w)}


def test_recall_at_the_threshold(spark):
    """Pairs of similarity 0.70 to 0.90: all links of 0.80 and more are found, no other."""
    r = random.Random(21)
    texts = []
    for _ in range(300):
        n = r.randint(30, 300)
        first = [f"v{r.randrange(3000)}" for _ in range(n)]
        second = list(first)
        for k in r.sample(range(n), max(1, round(n * r.uniform(0.03, 0.09)))):
            second[k] = f"v{r.randrange(3000)}"
        texts += [" ".join(first), " ".join(second)]
    sets = [_shingles(t) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    close = sum(len(sets[a] & sets[b]) < 0.85 * len(sets[a] | sets[b]) for a, b in links)
    assert close >= 50  # many links stand between 0.80 and 0.85
    label = list(range(len(texts)))
    for a, b in links:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = neardup.near_duplicates(docs).collect()
    assert {x.doc_id: x.component_id for x in out} == dict(enumerate(label))
    assert all(x.n_shingles == len(sets[x.doc_id]) and x.kept == (x.doc_id == x.component_id) for x in out)


def test_stages_bear_odd_rows(spark, tmp_path):
    """Null ids and texts, empty texts, repeated rows and names that stages use for columns of their own."""
    words = " ".join(f"q{i}" for i in range(60))
    rows = [(1, words, "x"), (1, words, "x"), (2, None, None), (None, None, "x"), (None, "a b c", "x"), (3, "", "x"), (4, "plain words of one text", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as tox_score", "2 as lines", "3 as decontam")
    spark.createDataFrame([(4, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("b", None), (None, "")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, now, str(tmp_path))
            assert after.columns == docs.columns and after.count() == (0 if empty else 6 if name in ("near_dedup", "decontamination") else 7)
            now = after
        packed = corpus_pipeline.pack(spark, now, str(tmp_path)).collect()
        assert len(packed) == (0 if empty else 6)
