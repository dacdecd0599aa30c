"""Operator 5: toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers letters, writes look-alike letters of other scripts and digits or signs in place of letters as the letter
they stand for, and turns other signs into spaces. The lexicon holds all words and word beginnings whose document
frequencies in labelled texts differ clearly by the likelihood ratio; their weights are log odds. A hit inside an exception
phrase doesn't count: phrases are given, or learned as pairs of a hit's word and a neighbour whose texts are clean by the
same ratio test against the other texts with that term. The sum of a text's weights, plain and for each hundred words, goes through a fitted logistic curve.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import lean, slices
from .store import small_batches

SAMPLE, LEAST_TEXTS, LEAST_RATIO = 10_000, 3, 20.0
PREFIXES = range(3, 10)
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "stupid simple", "loser bracket", "pond scum")

# fixed values: signs read as the letter they look like; 1, l and i fall together
_LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ӏ": "i", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ӧ": "ö", "ɡ": "g", "ⅼ": "i", "ο": "o",
}
_SIGNS = "".join(chr(c) for c in range(128) if not chr(c).isalnum() and chr(c) not in "@$") + " –—‘’“”…«»¡¿"
_DROPPED = "­​‌‍⁠﻿"
_FOLD = str.maketrans(_LOOKALIKES | dict.fromkeys(_SIGNS, " ") | dict.fromkeys(_DROPPED, "") | {chr(0xFF41 + i): "abcdefghijkimnopqrstuvwxyz"[i] for i in range(26)})


def fold(text: str | None) -> str:
    """The folded text with a space before and after it; compatibility forms (wide, ringed, styled letters) are plain ones."""
    text = text or ""
    plain = text if text.isascii() else unicodedata.normalize("NFKC", text)
    return f" {plain.lower().translate(_FOLD)} "


def _terms(text: str | None) -> set[str]:
    words = set(fold(text).split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in PREFIXES if len(w) > k}


def _count(terms: Callable[[str | None], set[str]]):  # noqa: ANN202
    """Labelled texts that hold each term, by label; the counts are handed on whenever they grow large."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}

        def rows() -> pa.RecordBatch:
            found = list(seen[0].keys() | seen[1].keys())
            return pa.record_batch([pa.array(found, pa.string()), *(pa.array([seen[k][t] for t in found], pa.int64()) for k in (0, 1))], ["term", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update(terms(text))
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield rows()
                    seen[0].clear()
                    seen[1].clear()
        yield rows()

    return count


def _counts(sample: DataFrame, terms: Callable[[str | None], set[str]]) -> DataFrame:
    return sample.select("text", "toxic").mapInArrow(lean(_count(terms)), "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").cast("double").alias("c"), F.sum("toxic").cast("double").alias("t"))


def _ratio(t: Column, c: Column, toxic: Column, clean: Column) -> Column:
    """The likelihood ratio of a term in t of `toxic` and c of `clean` texts against one rate in both."""
    share = (t + c) / (toxic + clean)

    def part(n: Column, total: Column, rate: Column) -> Column:
        none = total - n
        return F.when(n > 0, n * F.log(n / (total * rate))).otherwise(0.0) + F.when(none > 0, none * F.log(none / (total * (1 - rate)))).otherwise(0.0)

    return 2 * (part(t, toxic, share) + part(c, clean, share))


def learn_terms(sample: DataFrame) -> dict[str, float]:
    """The weights of all clear terms, none of which begins with another. Clear ones are few: each needs LEAST_TEXTS texts of the sample."""
    size = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    toxic, clean = float(size.t or 0), float(size.n - (size.t or 0))
    if not toxic or not clean:
        return {}
    t, c = F.col("t"), F.col("c")
    counts = _counts(sample, _terms).filter((t >= LEAST_TEXTS) & (t + c < toxic + clean) & (t / toxic > 2 * c / clean))
    clear = counts.withColumn("ratio", _ratio(t, c, F.lit(toxic), F.lit(clean))).filter(F.col("ratio") >= LEAST_RATIO)
    found: dict[str, float] = {}
    begun: set[str] = set()  # beginnings of the terms found
    for r in clear.orderBy(F.desc("ratio"), F.length("term"), "term").collect():  # bounded by the sample's texts
        starts = {r.term[:k] for k in range(1, len(r.term) + 1)}
        if r.term not in begun and not starts & found.keys():
            found[r.term] = math.log((r.t + 0.5) / (toxic + 1)) - math.log((r.c + 0.5) / (clean + 1))
            begun |= starts
    return found


def _phrases(matcher: Matcher) -> Callable[[str | None], set[str]]:
    """The words with hits, each after its term (TERM tab), and as pairs with the word before and the word behind."""

    def phrases(text: str | None) -> set[str]:
        words = fold(text).split()
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        found = set()
        for a, b, _ in matcher.hits(f" {' '.join(words)} "):
            i = bisect_right(starts, a) - 1
            term = f" {' '.join(words[i:i + 1])} "[: b - a]
            found.add(f"{term}\t")
            found.update(f"{term}\t {words[k]} {words[k + 1]} " for k in (i - 1, i) if 0 <= k < len(words) - 1)
        return found

    return phrases


def learn_exceptions(sample: DataFrame, matcher: Matcher) -> tuple[str, ...]:
    """Pairs of words around a hit, in at least LEAST_TEXTS texts, that are clean by the ratio test among the texts with the term."""
    counts = _counts(sample, _phrases(matcher)).select(F.split("term", "\t")[0].alias("of"), F.split("term", "\t")[1].alias("phrase"), "t", "c")
    terms = counts.filter("phrase = ''").select("of", F.col("t").alias("toxic"), F.col("c").alias("clean"))
    t, c, toxic, clean = map(F.col, ("t", "c", "toxic", "clean"))
    both = counts.filter("phrase <> ''").join(terms, "of").filter((toxic > 0) & (clean > 0) & (c >= LEAST_TEXTS) & (t + c < toxic + clean) & (c / clean > 2 * t / toxic))
    return tuple(sorted(r.phrase for r in both.filter(_ratio(t, c, toxic, clean) >= LEAST_RATIO).select("phrase").distinct().collect()))  # bounded by the sample's texts


class Matcher:
    def __init__(self, terms: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            folded = f" {' '.join(fold(phrase).split())} "
            self.automaton.add_word(folded, (len(folded), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """start, end and weight of each hit that no exception phrase covers."""
        if not len(self.automaton):
            return []
        found = [(end + 1 - n, end + 1, w) for end, (n, w) in self.automaton.iter(folded)]
        masks = sorted((a, b) for a, b, w in found if w is None)
        if not masks:
            return found
        starts, ends = [a for a, _ in masks], list(accumulate((b for _, b in masks), max))  # ends: the furthest of masks begun so far
        return [(a, b, w) for a, b, w in found if w is not None and ((k := bisect_right(starts, a)) == 0 or ends[k - 1] < b)]

    def features(self, text: str | None) -> tuple[float, float]:
        words = fold(text).split()
        total = sum(w for _, _, w in self.hits(f" {' '.join(words)} "))
        return math.log1p(total), math.log1p(100 * total / max(len(words), 10))


def _features(matcher: Matcher):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([matcher.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, 2)
            yield pa.record_batch([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("toxic")], ["x1", "x2", "toxic"])

    return features


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the constant last, of a ridge logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([*[1.0] * (x.shape[1] - 1), 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def is_training(folds: int = 5):  # noqa: ANN201
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds != 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 5, exceptions: tuple[str, ...] = EXCEPTIONS) -> tuple[Matcher, np.ndarray]:
    """Lexicon and curve from at most `sample` labelled training rows, those with the smallest id hashes."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    ids = known.filter(is_training(folds)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter("text is not null").select("text", "toxic").persist()
    try:
        terms = learn_terms(rows)
        matcher = Matcher(terms, (*exceptions, *learn_exceptions(rows, Matcher(terms, ()))))
        seen = rows.mapInArrow(lean(_features(matcher)), "x1 double, x2 double, toxic int").toPandas()  # bounded by `sample`
    finally:
        rows.unpersist()
    y = seen["toxic"].to_numpy(dtype=float)
    if len(set(y.tolist())) < 2:  # no rows, or all of one kind
        return matcher, np.array([0.0, 0.0, -5.0])
    return matcher, logistic(seen[["x1", "x2"]].to_numpy(), y)


def _scores(matcher: Matcher, curve: np.ndarray, column: str):
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            for part in slices(whole.select(["text"])):
                batch = whole.slice(at, part.num_rows)
                at += part.num_rows
                x = np.array([(*matcher.features(t), 1.0) for t in part.column("text").to_pylist()]).reshape(-1, 3)
                score = pa.array(1 / (1 + np.exp(-np.clip(x @ curve, -30, 30))))
                yield pa.record_batch([*batch.columns, score], [*batch.schema.names, column])

    return scores


def with_scores(docs: DataFrame, labels: DataFrame, column: str = "tox_score", **options) -> DataFrame:  # noqa: ANN003
    """docs with a score (0 to 1) in `column`, a name that docs lacks, for each row; null and empty texts score as texts without hits. No shuffle of texts.

    Without labels of both kinds no text is toxic.
    """
    from pyspark.sql.types import DoubleType, StructType

    small_batches(docs.sparkSession)
    schema = StructType([*docs.schema.fields]).add(column, DoubleType())
    return docs.mapInArrow(lean(_scores(*fit(docs, labels, **options), column)), schema)
