"""Mergeable summaries: distinct users (HLL), quantiles (KLL) and frequent values, kept by bucket and united on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K, KLL_K, TRACKED = 12, 200, 10_000
HLL_ERROR, KLL_ERROR = 0.05, 0.0165 * 2  # three standard errors of HLL at LOG_K; twice KLL's two-sided rank error at 99 %


def user_sketches(events: DataFrame, unit: str = "day") -> DataFrame:
    """bucket, event_type, users (an HLL sketch) of each bucket of time; rows without user or time count nowhere."""
    rows = events.filter("user_id IS NOT NULL AND event_time IS NOT NULL")
    return rows.groupBy(F.date_trunc(unit, "event_time").alias("bucket"), "event_type").agg(F.hll_sketch_agg("user_id", LOG_K).alias("users"))


def users_over(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """`by`, users: the estimated distinct users of united sketches; no event is read again."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


def value_sketches(rows: DataFrame, value: str, *by: Column | str) -> DataFrame:
    """`by`, values (a KLL sketch of the non-null values), n."""
    d = rows.filter(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    return d.groupBy(*by).agg(F.kll_sketch_agg_double(value, KLL_K).alias("values"), F.count("*").alias("n"))


def quantiles_over(sketches: DataFrame, points: dict[str, float], *by: Column | str) -> DataFrame:
    """`by`, n and the quantiles named by `points`, from merged sketches."""
    d = sketches.groupBy(*by).agg(F.kll_merge_agg_double("values").alias("values"), F.sum("n").alias("n"))
    keep = [c for c in d.columns if c != "values"]
    return d.select(*keep, *(F.kll_sketch_get_quantile_double("values", F.lit(q)).alias(name) for name, q in points.items()))


def fences(sketches: DataFrame, *by: str, width: float = 1.5) -> DataFrame:
    """`by`, low, high: quartiles of merged sketches widened by `width` times what lies between them."""
    q = quantiles_over(sketches, {"q1": 0.25, "q3": 0.75}, *by)
    reach = width * (F.col("q3") - F.col("q1"))
    return q.select(*by, "q1", "q3", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def outside(rows: DataFrame, value: str, bounds: DataFrame, *by: str) -> DataFrame:
    """The rows whose value lies outside their group's fences; bounds have one row a group and are broadcast if Spark finds them small."""
    return rows.join(bounds.select(*by, "low", "high"), list(by)).filter((F.col(value) < F.col("low")) | (F.col(value) > F.col("high")))


def heavy_hitters(rows: DataFrame, column: str, size: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The `size` most frequent values with exact counts, ties by value.

    A summary of at most `tracked` values, merged over partitions, names the candidates; a second pass counts only those,
    so what is shuffled doesn't grow with the number of values. What the summary leaves unnamed has at most 7 / tracked of
    the rows, or the estimate of the last candidate; if the last of the best is not above both, all values are counted.
    """
    rows = rows.filter(F.col(column).isNotNull())
    guess = rows.agg(F.expr(f"approx_top_k({column}, {min(2 * size, tracked)}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    if not guess.n:
        return rows.groupBy(column).agg(F.count("*").alias("events"))
    names = [r["item"] for r in guess.top]
    counted = rows.filter(F.col(column).isin(names)).groupBy(column).agg(F.count("*").alias("events"))
    best = counted.orderBy(F.desc("events"), column).limit(size).collect()
    unnamed = max(7 * guess.n / tracked, guess.top[-1]["count"] if len(names) == min(2 * size, tracked) else 0)
    if len(best) < size or best[-1].events <= unnamed:
        counted = rows.groupBy(column).agg(F.count("*").alias("events"))
    return counted.orderBy(F.desc("events"), column).limit(size)
