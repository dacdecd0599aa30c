"""Operator 3: quality rules with risk-controlled cutoffs.

Four rules measure a text: its shares of signs, repeated words, repeated lines and capitals. How much each counts is fitted
(logistic regression over all strata) on a fourth of the labelled texts, at most `SAMPLE` of them; the level of a text is
the chance of a bad label that they give, in BINS steps. The other labelled texts are the holdout that selects the cutoffs
of the level, one a stratum. Strata with too few good holdout labels to certify anything by themselves are pooled and share
one cutoff; who is pooled hangs on those numbers alone, never on the levels, so the tests stay exact. From strict to loose
in rejecting, a cutoff is certified while an exact binomial test refutes that the rejection rate of good texts exceeds
`alpha` at level `delta` / tests: fixed-sequence testing inside a stratum, Bonferroni over strata and pool. So with
probability 1 - delta no stratum of its own, nor the pooled ones taken together, loses more than `alpha` of its good texts.
Of the certified cutoffs the one with the best balance of bad against good rejected labels is used; a stratum that gains
nothing, or has no holdout label, rejects by the base only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import KEEP, Words, by_group, mix, raw, slices
from .store import settled
from .toxicity import logistic

ALPHA, DELTA, BINS, GOOD_WEIGHT, SAMPLE = 0.02, 0.05, 200, 10, 10_000
RULES = ("symbols", "repeats", "dup_lines", "capitals")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STEP = np.uint64(0x9FB21C651E98DF25)
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CAPITAL = (np.arange(256) >= 65) & (np.arange(256) <= 90)


def _each(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _repeats(words: Words) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in it."""
    h, n = words.hashes(), len(words.start)
    at = np.flatnonzero(np.arange(n) + 3 <= words.first[words.doc + 1])
    window = mix(mix(mix(h[at]) * _STEP + h[at + 1]) * _STEP + h[at + 2])
    order = by_group(words.doc[at], window)
    doc, value = words.doc[at][order], window[order]
    same = (doc[1:] == doc[:-1]) & (value[1:] == value[:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[at[order[twice]] + k] = True
    return np.bincount(words.doc, weights=covered, minlength=len(words.count)).astype(np.int64)


def _dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measure(text: pa.StringArray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text, and its rule values (a row each, columns as RULES)."""
    data, off = raw(text)
    words = Words(text, KEEP)
    lines = np.array([_dup_lines(t) for t in text.to_pylist()], dtype=np.int64).reshape(-1, 2)
    counts = {
        "n_words": words.count.astype(np.int64), "word_chars": _each((words.buf != 32) & (data & 0xC0 != 0x80), off),
        "n_symbols": _each(_SYMBOL[data], off), "n_dup_lines": lines[:, 1], "n_repeat_words": _repeats(words),
    }
    chars = np.maximum(counts["word_chars"], 1)
    values = np.stack([counts["n_symbols"] / chars, counts["n_repeat_words"] / np.maximum(words.count, 1), lines[:, 1] / np.maximum(lines[:, 0], 1), _each(_CAPITAL[data], off) / chars], axis=1)
    return counts, values


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def _bins(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values * BINS + 1e-9), 0, BINS).astype(np.int64)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            counts, values = measure(batch.column("text"))
            bins = pa.array(list(_bins(values).astype(np.int16)), pa.list_(pa.int16()))
            yield pa.record_batch([batch.column("doc_id"), batch.column("stratum"), *(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(base_failed(counts)), bins], ["doc_id", "stratum", *COUNTS, "base_failed", "bins"])


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts, base verdict and rule bins of each row; a null stratum is the empty one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measured, f"doc_id {kind}, stratum string, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, bins array<smallint>")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly, by its terms from k down."""
    if k >= n:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log)
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < 1e-18 * total:
            break
    return min(total, 1.0)


def certify(good: np.ndarray, bad: np.ndarray, alpha: float, delta: float) -> int | None:
    """The cutoff for a stratum from its labelled counts by level; None: reject nothing."""
    n, best, gain = int(good.sum()), None, 0
    lost, caught = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    for cut in range(len(good) - 1, 0, -1):
        k = int(lost[cut])
        if n == 0 or k > alpha * n or binomial_tail(k, n, alpha) > delta:
            break
        if (now := int(caught[cut]) - GOOD_WEIGHT * k) > gain:
            best, gain = cut, now
    return best


def is_holdout() -> Column:
    """Whether a labelled text selects cutoffs; the others fit the weights of the rules."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 != 0


def _known(labels: DataFrame) -> DataFrame:
    return labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))


def weights(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Of each rule and the constant, from at most `sample` labelled texts; zero without labels of both kinds."""
    rows = measured.filter("not base_failed").join(_known(labels).filter(~is_holdout()), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample).select("bins", (F.col("quality") <= 0).cast("int").alias("bad")).collect()
    y = np.array([r.bad for r in rows], dtype=float)
    if len(set(y.tolist())) < 2:
        return np.zeros(len(RULES) + 1)
    return logistic(np.log1p(np.array([r.bins for r in rows], dtype=float)), y)


def with_levels(measured: DataFrame, w: np.ndarray) -> DataFrame:
    score = sum((float(c) * F.log1p(F.col("bins")[i]) for i, c in enumerate(w[:-1])), F.lit(float(w[-1])))
    return measured.withColumn("level", F.floor(BINS / (1 + F.exp(-score))).cast("int"))


def least_good(alpha: float, delta: float) -> int:
    """Good labels, none of them rejected, that certify a cutoff."""
    return math.ceil(math.log(delta) / math.log1p(-alpha))


def cutoffs(leveled: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Rows (of, cut): the certified cutoff level of each stratum that has one, its own or that of the pool."""
    rows = leveled.filter("not base_failed").select("doc_id", "stratum", "level").join(_known(labels).filter(is_holdout()), "doc_id")
    good = (F.col("quality") > 0).cast("long")
    cells = settled(rows.groupBy("stratum", "level").agg(F.sum(good).alias("good"), F.sum(1 - good).alias("bad")))  # BINS + 1 rows a stratum at most
    sizes = cells.groupBy("stratum").agg(F.sum("good").alias("n"))
    own = F.col("n") >= least_good(alpha, delta / max(1, sizes.count()))
    tests = sizes.agg(F.count_if(own).alias("own"), F.max((~own).cast("int")).alias("pool")).first()
    each = delta / max(1, tests.own + (tests.pool or 0))
    group = sizes.select(F.col("stratum").alias("of"), F.when(own, F.col("stratum")).alias("group"))  # null: the pool

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((2, BINS + 1), dtype=np.int64)
        np.add.at(counts, (slice(None), batch["level"].to_numpy()), batch[["good", "bad"]].to_numpy().T)
        return pd.DataFrame({"group": batch["group"].iloc[:1], "cut": [certify(*counts, alpha, each)]}).dropna(subset="cut")

    summed = cells.join(group, cells.stratum == group.of).groupBy("group", "level").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    cuts = settled(summed.groupBy("group").applyInPandas(cut, "group string, cut int"))
    return group.join(cuts, group.group.eqNullSafe(cuts.group)).select("of", "cut")


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **limits) -> DataFrame:  # noqa: ANN003
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, level for each row.

    Null and empty texts have no words and fail the base rules. A null stratum is a stratum of its own. Without labels
    only the base rules reject. Rows of a repeated id are judged each, and each meets the id's label. Texts are read once
    and not shuffled; labels meet the counts.
    """
    found = settled(measures(docs, stratum))
    leveled = with_levels(found, weights(found, labels))
    limit = settled(cutoffs(leveled, labels, **limits))
    kept = ~F.col("base_failed") & F.coalesce(F.col("level") < F.col("cut"), F.lit(True))
    return leveled.join(limit, leveled.stratum == F.col("of"), "left").select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "level")
