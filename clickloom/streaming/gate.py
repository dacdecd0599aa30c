"""The quality gate on micro-batches: each is counted before it is written; a bad one is audited and stops the stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import events as ev
from ..operators.quality import REQUIRED, GateError
from ..sources import sinks
from .speed import contract_events


def batch_checks(batch: DataFrame, max_rejected: float) -> DataFrame:
    """check_name, status, observed_value, expectation of a micro-batch of contract rows, in one pass."""
    good = F.col("rejection_reason").isNull()
    missing = F.lit(False)
    for c in REQUIRED:
        missing = missing | F.col(c).isNull()
    row = batch.agg(
        F.count("*").alias("rows"), F.count_if(~good).alias("rejected"), F.count_if(good & missing).alias("missing"),
        (F.count_if(good) - F.count_distinct(F.when(good, F.col("event_key")))).alias("repeated"))
    checks = {
        "batch_rejected_share": ("rejected", F.col("rejected") <= F.col("rows") * max_rejected, f"<= {max_rejected:g} of the rows"),
        "batch_required_fields_complete": ("missing", F.col("missing") == 0, "= 0 null rows"),
        "batch_event_key_unique": ("repeated", F.col("repeated") == 0, "= 0 duplicates"),
    }
    cells = [F.struct(F.lit(n).alias("check_name"), F.when(ok, "PASSED").otherwise("FAILED").alias("status"), F.col(c).alias("observed_value"), F.lit(e).alias("expectation")) for n, (c, ok, e) in checks.items()]
    return row.select(F.inline(F.array(*cells)))


def gated_writer(path: str, dead: str, base: str, run_id: str, max_rejected: float):  # noqa: ANN201
    """A foreachBatch writer behind the gate; audit rows carry the run and the batch, and one delivered again adds a newer row."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch_checks(batch, max_rejected).collect()  # three rows
            spark = batch.sparkSession
            found = spark.createDataFrame(rows, "check_name string, status string, observed_value long, expectation string")
            sinks.audit(found.withColumn("run_id", F.lit(f"{run_id}/{batch_id}")), base, "data_quality_result")
            failed = [f"{r.check_name} ({r.observed_value})" for r in rows if r.status != "PASSED"]
            if failed:
                raise GateError(f"batch {batch_id}: {', '.join(failed)}")
            batch.filter("rejection_reason IS NULL").drop("rejection_reason", "raw_message").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            ev.dead_letters(batch.filter("rejection_reason IS NOT NULL"), "events").write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_gated(messages: DataFrame, path: str, dead: str, checkpoint: str, base: str, run_id: str, ingested_at: datetime, max_rejected: float = 0.5, watermark: str = "2 minutes", every: str | None = "10 seconds") -> StreamingQuery:
    """As speed.start_raw, behind the gate: a batch with more than `max_rejected` rejects ends the query and nothing of it is written.

    The batch isn't committed, so a query started again from the checkpoint begins with it.
    """
    rows = contract_events(messages, run_id, ingested_at).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_key"])
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(gated_writer(path, dead, base, run_id, max_rejected)).option("checkpointLocation", checkpoint).trigger(**trigger).start()
