"""Pooled quality strata and the toxicity query, each from its definition."""

from __future__ import annotations

import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from clickloom.llm import quality, toxicity


def _tail(k: int, n: int, p: Fraction) -> Fraction:
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def _crc(i: int) -> int:
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("sizes", [(1200, 220, 200), (260, 250)])
def test_small_strata_are_pooled(spark, sizes):
    """Levels, tests and cutoffs recomputed: a large stratum by itself, small ones together, one without labels by the base only."""
    r = random.Random(11)
    rows, marks = [], []
    for s, n in enumerate([*sizes, 40]):
        for _ in range(n):
            bad, i = r.random() < 0.3, len(rows)
            rows.append((i, " ".join(f"w{r.randrange(400)}" + ("###" if bad and r.random() < 0.5 else "") for _ in range(60)), f"s{s}"))
            if s < len(sizes):
                marks.append((i, int(not bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int")
    found = {x.doc_id: x for x in quality.judged(docs, labels).collect()}
    bins = {x.doc_id: x.bins for x in quality.measures(docs).collect()}
    fit = [(np.log1p(bins[i]), 1 - q) for i, q in marks if _crc(i) % 4 == 0 and not found[i].base_failed]
    w = toxicity.logistic(np.array([x for x, _ in fit]), np.array([y for _, y in fit], dtype=float))
    level = {i: math.floor(quality.BINS / (1 + math.exp(-(np.log1p(b) @ w[:-1] + w[-1])))) for i, b in bins.items()}
    held = {f"s{s}": [(level[i], q) for i, q in marks if rows[i][2] == f"s{s}" and _crc(i) % 4 and not found[i].base_failed] for s in range(len(sizes))}
    alpha, delta = Fraction(str(quality.ALPHA)), Fraction(str(quality.DELTA))
    own = {s: _tail(0, sum(q for _, q in h), alpha) <= delta / len(held) for s, h in held.items()}
    groups = {s: s if own[s] else "pool" for s in held}
    cuts = {}
    for g in set(groups.values()):
        rows_of = [x for s, h in held.items() if groups[s] == g for x in h]
        good, best, gain = sum(q for _, q in rows_of), None, 0
        for cut in range(quality.BINS, 0, -1):
            k, caught = sum(q for x, q in rows_of if x >= cut), sum(1 - q for x, q in rows_of if x >= cut)
            if k > alpha * good or _tail(k, good, alpha) > delta / len(set(groups.values())):
                break
            if caught - quality.GOOD_WEIGHT * k > gain:
                best, gain = cut, caught - quality.GOOD_WEIGHT * k
        cuts[g] = best
    assert "pool" in cuts and cuts["pool"] is not None
    for i, x in found.items():
        cut = cuts.get(groups.get(rows[i][2], ""))
        assert x.level == level[i] and x.kept == (not x.base_failed and (cut is None or level[i] < cut))


def _brute(rows: list[tuple[int, str | None]], marks: dict[int, int]) -> dict[int, float]:
    """Scores from the definition, by plain loops over all terms and all places."""
    train = [(t, marks[i]) for i, t in rows if i in marks and _crc(i) % 5 and t is not None]
    toxic, clean = sum(y for _, y in train), sum(1 - y for _, y in train)

    def ratio(t: int, c: int, toxic: int, clean: int) -> float:
        share = (t + c) / (toxic + clean)
        return 2 * sum(n * math.log(n / (total * rate)) for n, total, rate in ((t, toxic, share), (toxic - t, toxic, 1 - share), (c, clean, share), (clean - c, clean, 1 - share)) if n)

    texts = [(" " + " ".join(toxicity.fold(t).split()) + " ", y) for t, y in train]
    terms = {f" {w} " for t, _ in texts for w in t.split()} | {f" {w[:k]}" for t, _ in texts for w in t.split() for k in toxicity.PREFIXES if len(w) > k}
    clear = []
    for x in terms:
        t, c = sum(x in s for s, y in texts if y), sum(x in s for s, y in texts if not y)
        if f"{x}"[-1] != " ":  # a beginning is not the whole word
            t, c = (sum(any(w.startswith(x[1:]) and w != x[1:] for w in s.split()) for s, y in texts if y == k) for k in (1, 0))
        if t >= toxicity.LEAST_TEXTS and t + c < len(texts) and t / toxic > 2 * c / clean and ratio(t, c, toxic, clean) >= toxicity.LEAST_RATIO:
            clear.append((-ratio(t, c, toxic, clean), len(x), x, math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))))
    lexicon: dict[str, float] = {}
    for _, _, x, weight in sorted(clear):
        if not any(x.startswith(y) or y.startswith(x) for y in lexicon):
            lexicon[x] = weight
    pairs: dict[tuple[str, str], list[int]] = {}
    holds: dict[str, list[int]] = {}
    for s, y in texts:
        w, seen = s.split(), set()
        for x in lexicon:
            at = [i for i, word in enumerate(w) if f" {word} ".startswith(x)]
            if at:
                holds.setdefault(x, [0, 0])[y] += 1
            seen |= {(x, f" {w[k]} {w[k + 1]} ") for i in at for k in (i - 1, i) if 0 <= k < len(w) - 1}
        for p in seen:
            pairs.setdefault(p, [0, 0])[y] += 1
    masks = [f" {' '.join(toxicity.fold(p).split())} " for p in toxicity.EXCEPTIONS]
    for (x, phrase), (c, t) in pairs.items():
        cn, tn = holds[x]
        if tn and cn and c >= toxicity.LEAST_TEXTS and t + c < tn + cn and c / cn > 2 * t / tn and ratio(t, c, tn, cn) >= toxicity.LEAST_RATIO:
            masks.append(phrase)

    def features(text: str | None) -> list[float]:
        w = toxicity.fold(text).split()
        s = f" {' '.join(w)} "
        covered = [(i, i + len(m)) for m in masks for i in range(len(s)) if s.startswith(m, i)]
        total = sum(weight for x, weight in lexicon.items() for i in range(len(s)) if s.startswith(x, i) and not any(a <= i and i + len(x) <= b for a, b in covered))
        return [math.log1p(total), math.log1p(100 * total / max(len(w), 10))]

    curve = toxicity.logistic(np.array([features(t) for t, _ in train]), np.array([y for _, y in train], dtype=float))
    return {i: 1 / (1 + math.exp(-float(np.array([*features(t), 1.0]) @ curve))) for i, t in rows}


def test_toxicity_by_brute_force(spark):
    r = random.Random(8)
    long = "verylongslurwordofmorethantwentyfourletters"
    rows, marks = [], {}
    for i in range(400):
        bad = r.random() < 0.25
        w = [f"w{r.randrange(60)}" for _ in range(r.randint(5, 40))]
        if bad:
            w.insert(r.randrange(len(w)), r.choice([long, "zorg", "z0rg", "zorg"]))
        elif r.random() < 0.15:
            k = r.randrange(len(w))
            w[k:k] = ["zorg", "cake"]  # a clean phrase around the term
        rows.append((i, " ".join(w)))
        if i % 10 != 9:
            marks[i] = int(bad)
    rows += [(400, None), (401, ""), (402, "z0rg!"), (403, "a zorg cake"), (404, "zorg cake zorg"), (405, long.upper())]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(marks.items()), "doc_id long, toxic int")
    out = {x.doc_id: x.tox_score for x in toxicity.with_scores(docs, labels).collect()}
    want = _brute(rows, marks)
    assert out.keys() == want.keys() and all(out[i] == pytest.approx(want[i], abs=1e-6) for i in want)
    assert out[402] >= 0.5 and out[405] >= 0.5 and out[404] > out[403] < 0.5


def test_masks_of_a_long_text():
    """Many phrases and hits in one text: each hit is held against the furthest mask only."""
    m = toxicity.Matcher({" zorg ": 1.0, " zo": 0.5}, ("zorg cake", "big zorg cake"))
    text = " ".join(["zorg cake", "zorg", "big zorg cake"] * 40_000)
    assert len(m.hits(f" {text} ")) == 80_000
