"""Windowed metrics and the dashboard queries over events, metrics and model results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SERIES_LENGTH, KPI_SECONDS = 241, 3600


def windowed_metrics(events: DataFrame, window: str = "1 minute", watermark: str | None = "2 minutes", exact: bool = False) -> DataFrame:
    """Events, users and amount by tumbling window and type; the same plan for batch and stream.

    events: event_time (timestamp), event_type, user_id, price. exact: exact users, for batch only.
    """
    if events.isStreaming and watermark:
        events = events.withWatermark("event_time", watermark)
    users = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")
    d = events.groupBy(F.window("event_time", window).alias("w"), "event_type").agg(F.count("*").alias("event_count"), users.alias("unique_users"), F.sum(F.coalesce(F.col("price").cast("double"), F.lit(0.0))).alias("amount"))
    return d.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "event_count", "unique_users", "amount")


def with_revenue(metrics: DataFrame) -> DataFrame:
    """The amount counts as revenue for purchases only."""
    return metrics.withColumn("revenue", F.expr("CASE WHEN event_type = 'purchase' THEN amount ELSE 0.0D END"))


def latest_kpi(metrics: DataFrame) -> DataFrame:
    """The newest window of each event type."""
    fields = [c for c in metrics.columns if c not in ("event_type", "window_start")]
    d = metrics.groupBy("event_type").agg(F.max_by(F.struct("window_start", *fields), "window_start").alias("m"))
    return d.select("event_type", "m.*")


def unexpired(kpi: DataFrame, ttl: int = KPI_SECONDS) -> DataFrame:
    """The KPI rows whose window began at most `ttl` seconds before the newest one."""
    newest = kpi.agg(F.max("window_start").alias("newest"))  # one row
    live = F.unix_timestamp("window_start") + ttl >= F.unix_timestamp("newest")
    return kpi.join(F.broadcast(newest), live).drop("newest")


def revenue_series(metrics: DataFrame, limit: int = SERIES_LENGTH) -> DataFrame:
    """t, revenue of the newest purchase windows, newest first."""
    return metrics.filter("event_type = 'purchase'").select(F.col("window_start").alias("t"), "revenue").orderBy(F.desc("t")).limit(limit)


def total(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("events"))


def active_users(events: DataFrame, exact: bool = True) -> DataFrame:
    return events.agg((F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")).alias("active_users"))


def date_histogram(events: DataFrame, unit: str = "hour") -> DataFrame:
    return events.groupBy(F.date_trunc(unit, "event_time").alias("bucket")).agg(F.count("*").alias("events"))


def top_terms(events: DataFrame, column: str, size: int = 10) -> DataFrame:
    """The most frequent values of a column."""
    return events.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("events")).orderBy(F.desc("events"), column).limit(size)


def by_type(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("event_type").agg(F.sum("event_count").alias("event_count"))


def over_time(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("window_start").agg(F.sum("revenue").alias("revenue"))


def predicted_by_day(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("forecast_date", "model").agg(F.sum("predicted_revenue").alias("predicted_revenue"))


def score_by_day(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("event_date").agg(F.max("anomaly_score").alias("anomaly_score"))
