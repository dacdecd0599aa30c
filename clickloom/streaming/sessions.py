"""Sessions on the stream: running totals of each session in keyed state, with rows late within the watermark counted in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import MART_COLUMNS
from .speed import contract_events, last_batches

KINDS = ("view", "cart", "purchase")


def session_updates(events: DataFrame, watermark: str = "2 minutes", idle_ms: int = 86_400_000) -> DataFrame:
    """A stream of canonical events as a stream of session totals so far; each event counts once within the watermark.

    Totals are kept for each session and span of `idle_ms`: a fragment, which is given again by each micro-batch with rows
    of it. Its state goes when the watermark has passed the end of the span. A session that goes on later has further
    fragments, which `read_sessions` adds up.
    """
    once = events.filter("trim(session_id) <> ''").withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_key"])
    head = F.min(F.struct(F.unix_micros("event_time").alias("first"), F.col("event_key").alias("first_key"), F.col("source_user_id").alias("user_id"))).alias("head")
    tallies = [F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in KINDS]
    totals = once.groupBy("session_id", F.window("event_time", f"{idle_ms} milliseconds").alias("span")).agg(head, F.max(F.unix_micros("event_time")).alias("last"), *tallies, F.collect_set("source_product_id").alias("products"))
    return totals.select("session_id", F.col("span.start").cast("string").alias("fragment"), "head.*", "last", *(f"n_{k}" for k in KINDS), "products")


def start_sessions(messages: DataFrame, path: str, checkpoint: str, run_id: str, ingested_at: datetime, watermark: str = "2 minutes", idle_ms: int = 86_400_000, every: str | None = "10 seconds") -> StreamingQuery:
    """Session totals of the valid events among messages, each micro-batch in a folder of its own; a batch delivered again replaces it."""
    events = contract_events(messages, run_id, ingested_at).filter("rejection_reason IS NULL")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return session_updates(events, watermark, idle_ms).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The sessions so far, in the columns of session_daily: the last totals of each fragment, fragments added up."""
    newest = Window.partitionBy("session_id", "fragment").orderBy(F.desc("batch_id"))
    last = last_batches(spark, path).withColumn("place", F.row_number().over(newest)).filter("place = 1")
    d = last.groupBy("session_id").agg(
        F.min_by("user_id", F.struct("first", "first_key")).alias("user_id"), F.timestamp_micros(F.min("first")).alias("session_start"), F.timestamp_micros(F.max("last")).alias("session_end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("products")))).cast("long").alias("product_count"), *(F.sum(f"n_{k}").alias(f"{k}_count") for k in KINDS))
    outcome = F.when(F.col("purchase_count") > 0, "converted").when(F.col("cart_count") > 0, "abandoned_cart").otherwise("browsing")
    d = d.withColumns({"event_count": F.col("view_count") + F.col("cart_count") + F.col("purchase_count"), "session_outcome": outcome, "event_date": F.to_date("session_start")})
    return d.withColumn("duration_seconds", F.unix_timestamp("session_end") - F.unix_timestamp("session_start")).select(*MART_COLUMNS["session_daily"])
