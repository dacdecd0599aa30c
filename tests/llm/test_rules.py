"""Certified quality cutoffs, folded toxic words, long words, and clashing columns."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from clickloom.llm import decontam, lines, quality, toxicity
from clickloom.llm.arrays import HASHED, span_hash


def test_kept_by_brute_force(spark):
    """The verdict from the definition: fitted weights, holdout counts, exact binomial tail, best certified cutoff."""
    r = random.Random(3)
    rows, marks = [], []
    for i in range(1600):
        bad = r.random() < 0.3
        w = [f"w{r.randrange(400)}" + ("###" if bad and r.random() < 0.5 else "") for _ in range(r.randint(60, 90))]
        rows.append((i, " ".join(w), "ab"[i % 2]))
        marks.append((i, int(not bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int")
    found = {x.doc_id: x for x in quality.judged(docs, labels).collect()}
    cuts = {}
    for lang in "ab":
        held = [(found[i].level, q) for i, q in marks if rows[i][2] == lang and zlib.crc32(str(i).encode()) % 4 != 0 and not found[i].base_failed]
        good = sum(q for _, q in held)
        best, gain = None, 0
        for cut in range(quality.BINS, 0, -1):
            k, caught = sum(q for x, q in held if x >= cut), sum(1 - q for x, q in held if x >= cut)
            if k > quality.ALPHA * good or quality.binomial_tail(k, good, quality.ALPHA) > quality.DELTA / 2:
                break
            if caught - quality.GOOD_WEIGHT * k > gain:
                best, gain = cut, caught - quality.GOOD_WEIGHT * k
        cuts[lang] = best
    assert all(c is not None for c in cuts.values())  # it decides
    for i, x in found.items():
        assert x.kept == (not x.base_failed and x.level < cuts[rows[i][2]])
    assert sum(found[i].kept == bool(q) for i, q in marks) > 1500
    again = quality.judged(docs.union(docs.limit(3)), labels).groupBy("doc_id").agg(F.count_distinct("kept").alias("k")).filter("k > 1")
    assert again.count() == 0


def test_one_kind_of_label(spark):
    docs = spark.createDataFrame([(i, f"word{i} other") for i in range(20)] + [(None, None)], "doc_id long, text string")
    for toxic in (0, 1):
        labels = spark.createDataFrame([(i, toxic) for i in range(20)], "doc_id long, toxic int")
        assert toxicity.with_scores(docs, labels).filter("tox_score >= 0.5").count() == 0


def test_compatibility_letters():
    m = toxicity.Matcher({" siur ": 2.0})
    assert m.features("ｓｌｕｒ") == m.features("𝐬𝐥𝐮𝐫") == m.features("ⓢlur") == m.features("slur") and m.features("slur")[0] > 0


def test_hash_of_long_words():
    """A word's hash does not hang on where it stands, whatever its length."""
    word = np.random.default_rng(0).integers(97, 122, 2 * HASHED + 77, dtype=np.uint8)
    short = word[:9]
    for lead in (0, 5, HASHED - 3):
        buf = np.concatenate([np.full(lead, 32, np.uint8), short, [32], word, [32], short]).astype(np.uint8)
        start = np.array([lead, lead + 10, lead + 11 + len(word)])
        h = span_hash(buf, start, start + np.array([9, len(word), 9]))
        if not lead:
            first = h
        assert h.tolist() == first.tolist() and h[0] == h[2] != h[1]
    other = word.copy()
    other[HASHED + 5] ^= 1
    assert span_hash(other, np.array([0]), np.array([len(other)]))[0] != first[1]


def test_clashing_columns_and_repeated_rows(spark):
    w = [f"x{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(["lead", *w[:20], "tail"]), "keep")] * 2 + [(1, "clean text here", "keep"), (2, None, "keep")], "doc_id long, text string, decontam string")
    bench = spark.createDataFrame([(7, " ".join(w[:20]))], "item_id long, text string")
    out = sorted((x.doc_id, x.text or "", x.decontam) for x in decontam.clean_spans(docs, bench).collect())
    assert out == [(1, "clean text here", "keep"), (1, "lead tail", "keep"), (1, "lead tail", "keep"), (2, "", "keep")]
    assert decontam.clean_documents(docs, bench).count() == 2
    assert lines.dedup_lines(docs, column="l").count() == 4
