"""The data-quality gate, and descriptive statistics of a daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .star import orphans

FEATURES = ("revenue", "purchase_events", "avg_purchase_value")
REQUIRED = ("event_key", "event_time", "source_user_id", "source_product_id")


class GateError(Exception):
    """A quality check failed; nothing was published."""


def checks(events: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """check_name, status, observed_value, expectation: five rows from one pass over events and one each over the others."""
    missing = F.lit(False)
    for c in REQUIRED:
        missing = missing | F.col(c).isNull()
    seen = events.agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct("event_key")).alias("dup"), F.count_if(missing).alias("missing"))
    lost = orphans(events, dims).agg(F.sum("orphans").alias("lost"))
    products = dims["dim_product"].agg(F.count("*").alias("products"))
    row = seen.crossJoin(lost).crossJoin(products)  # one row each
    named = {"silver_not_empty": ("n", "> 0"), "event_key_unique": ("dup", "= 0 duplicates"), "required_fields_complete": ("missing", "= 0 null rows"), "fact_has_no_dimension_orphans": ("lost", "= 0 orphan rows"), "product_dimension_not_empty": ("products", "> 0")}
    cells = F.array(*(F.struct(F.lit(k).alias("check_name"), F.when(F.expr(f"{c} {e[:3]}"), "PASSED").otherwise("FAILED").alias("status"), F.col(c).alias("observed_value"), F.lit(e).alias("expectation")) for k, (c, e) in named.items()))
    return row.select(F.inline(cells))


def enforce(results: DataFrame) -> None:
    failed = [f"{r.check_name} ({r.observed_value})" for r in results.filter("status <> 'PASSED'").collect()]  # five rows at most
    if failed:
        raise GateError("quality gate failed: " + ", ".join(failed))


def profile(series: DataFrame) -> DataFrame:
    """feature, n, mean, std, min, quartiles, max, cv: of each feature, in one pass."""
    parts = []
    for f in FEATURES:
        x = F.col(f).cast("double")
        parts.append(F.struct(
            F.lit(f).alias("feature"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.percentile(x, 0.25).alias("q1"),
            F.percentile(x, 0.5).alias("median"), F.percentile(x, 0.75).alias("q3"), F.max(x).alias("max"), (F.stddev_samp(x) / F.avg(x) * 100).alias("cv")).alias(f))
    return series.agg(*parts).select(F.inline(F.array(*FEATURES)))


def gaps(series: DataFrame) -> DataFrame:
    """null_cells, duplicate_days of a series table."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in FEATURES), F.lit(0))
    return series.agg(nulls.alias("null_cells"), (F.count("event_date") - F.count_distinct("event_date")).alias("duplicate_days"))


def missing_days(series: DataFrame) -> DataFrame:
    """Days between the first and last one that have no row."""
    ends = series.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi")).filter("lo IS NOT NULL")
    return ends.select(F.explode(F.sequence("lo", "hi")).alias("event_date")).join(series.select("event_date"), "event_date", "left_anti")


def weekday_stats(series: DataFrame) -> DataFrame:
    """Mean, days and quartiles of revenue by weekday, Monday = 0."""
    x = F.col("revenue")
    return series.groupBy(F.weekday("event_date").alias("weekday")).agg(F.avg(x).alias("mean_revenue"), F.count("*").alias("days"), *(F.percentile(x, q).alias(n) for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))))


def correlations(series: DataFrame) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]]
    return series.agg(*(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs))).select(
        F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("pearson")) for i, (a, b) in enumerate(pairs)))))


def iqr_outliers(series: DataFrame, width: float = 1.5) -> DataFrame:
    """feature, event_date, value of rows beyond the quartiles by `width` times their distance."""
    long = series.select("event_date", F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in FEATURES))))
    q = long.groupBy("feature").agg(F.percentile("value", 0.25).alias("q1"), F.percentile("value", 0.75).alias("q3"))
    away = F.expr(f"value < q1 - {width} * (q3 - q1) OR value > q3 + {width} * (q3 - q1)")
    return long.join(F.broadcast(q), "feature").filter(away).select("feature", "event_date", "value")  # q: a row a feature


def rolling_mean(series: DataFrame, keys: tuple[str, ...] = (), reach: int = 1) -> DataFrame:
    """Centred mean of 2 * reach + 1 days; NULL where the window is cut off. keys: the series columns, for many series."""
    w = Window.partitionBy(*keys).orderBy("event_date").rowsBetween(-reach, reach)
    full = F.count("revenue").over(w) == 2 * reach + 1
    return series.withColumn("rolling_mean", F.when(full, F.avg("revenue").over(w)))


def histogram(series: DataFrame, bins: int = 10) -> DataFrame:
    """bin (1..bins), days: equal-width bins of revenue; the last one is closed."""
    ends = series.agg(F.min("revenue").alias("lo"), F.max("revenue").alias("hi"))
    b = F.expr(f"least({bins}, 1 + CAST(floor((revenue - lo) / (hi - lo) * {bins}) AS INT))")
    return series.crossJoin(F.broadcast(ends)).filter("hi > lo").groupBy(b.alias("bin")).agg(F.count("*").alias("days"))  # ends: one row
