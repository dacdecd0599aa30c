"""The stream: windowed metrics with an idempotent sink, a raw-event sink, and rejects to dead letters."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import events as ev
from ..operators import prices as pr
from ..operators.serving import KPI_SECONDS, SERIES_LENGTH, latest_kpi, unexpired, windowed_metrics, with_revenue
from ..sources.commits import CommitLog, Conflict, Folder
from ..sources.files import decode, decode_all


def write_metrics(path: str, served: str | None = None, compact_every: int = 100, retain: int = 0, ttl: int = KPI_SECONDS):  # noqa: ANN201
    """A foreachBatch writer: each micro-batch replaces its own folder, so a batch delivered again changes nothing.

    served: where the latest KPI of each type and the newest points of the revenue series are kept as tables of their own.
    Every `compact_every` batches the folders of batches before the current one, which can't come again, are merged;
    folders that merged ones replace stay for `retain` further merges, for readers that began before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if served:
            serve(spark, spark.read.schema(batch.schema).parquet(f"{path}/batch_id={batch_id}"), served, batch_id, ttl)
        if batch_id and batch_id % compact_every == 0:
            compact_metrics(spark, path, batch_id, retain)

    return write


def serve(spark: SparkSession, metrics: DataFrame, served: str, batch_id: int, ttl: int = KPI_SECONDS) -> None:
    """Merges a batch's metrics into the KPI and series tables; both are bounded, and the batch before is what they start from.

    A type's KPI expires once its window began more than `ttl` seconds of event time before the newest window of any type.
    """
    now = with_revenue(metrics)
    rows = {"kpi": now, "revenue_series": now.filter("event_type = 'purchase'").select(F.col("window_start").alias("t"), "revenue")}
    for name, df in rows.items():
        old = _versions(spark, f"{served}/{name}", batch_id)
        if old:
            df = df.withColumn("new", F.lit(1)).unionByName(spark.read.parquet(f"{served}/{name}/batch_id={old[-1]}").withColumn("new", F.lit(0)), allowMissingColumns=True)
            key = ["event_type", "window_start"] if name == "kpi" else ["t"]
            rest = [c for c in df.columns if c not in (*key, "new")]
            df = df.groupBy(*key).agg(F.max_by(F.struct(*rest), "new").alias("m")).select(*key, "m.*")
        df = unexpired(latest_kpi(df), ttl) if name == "kpi" else df.orderBy(F.desc("t")).limit(SERIES_LENGTH)
        df.coalesce(1).write.mode("overwrite").parquet(f"{served}/{name}/batch_id={batch_id}")
        for gone in old[:-1]:
            _delete(spark, f"{served}/{name}/batch_id={gone}")


def read_served(spark: SparkSession, served: str, name: str) -> DataFrame:
    """The table `kpi` or `revenue_series` after the last batch."""
    return spark.read.parquet(f"{served}/{name}/batch_id={_versions(spark, f'{served}/{name}')[-1]}")


def _metrics_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/_log")


def _snapshot(spark: SparkSession, path: str, state: dict, below: int | None = None) -> DataFrame | None:
    """Rows with their batch_id: the merged folder that a commit names, and the batches after those merged."""
    upto, merged = state["notes"].get("upto", -1), state["notes"].get("merged")
    folders = [f"{path}/batch_id={n}" for n in _versions(spark, path, below) if n > upto]
    parts = [spark.read.parquet(f"{path}/{merged}")] if merged else []
    if folders:
        parts.append(spark.read.option("basePath", path).parquet(*folders).withColumn("batch_id", F.col("batch_id").cast("long")))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def compact_metrics(spark: SparkSession, path: str, below: int, retain: int = 0) -> None:
    """Merges the batches before `below` into a folder that a commit names; what it replaces goes after `retain` more merges.

    A batch that is delivered again writes its own folder, which readers skip if the merged one holds it. A crash before the
    commit leaves a folder that nobody reads, one after it leaves old folders, which the next merge removes. Where two jobs
    merge at once, one finds its number taken and gives up.
    """
    log = _metrics_log(spark, path)
    number, state = log.state()
    new = [n for n in _versions(spark, path, below) if n > state["notes"].get("upto", -1)]
    if not new:
        return
    name = f"_merged-{uuid.uuid4().hex}"
    _last(_snapshot(spark, path, state, below), keep_batch=True).write.parquet(f"{path}/{name}")
    try:
        log.commit(number + 1, notes={"merged": name, "upto": new[-1]})
    except Conflict:
        _delete(spark, f"{path}/{name}")
        return
    held = [log.state(n)[1]["notes"] for n in range(max(1, number + 1 - retain), number + 2)]
    safe = min(h["upto"] for h in held) if number + 1 > retain else -1
    for n in _versions(spark, path, safe + 1):
        _delete(spark, f"{path}/batch_id={n}")
    for old in (n for n in Folder(spark, path).names() if n.startswith("_merged-") and n not in {h["merged"] for h in held}):
        if number + 1 > retain:
            _delete(spark, f"{path}/{old}")


def _versions(spark: SparkSession, path: str, below: int | None = None) -> list[int]:
    """The batches that have a folder, in order; those before `below` if it is given."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    found = sorted(int(x.split("=")[1]) for x in names if x.startswith("batch_id="))
    return [x for x in found if below is None or x < below]


def last_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches with their batch_id."""
    folders = [f"{path}/batch_id={n}" for n in _versions(spark, path)]
    return spark.read.option("basePath", path).parquet(*folders).withColumn("batch_id", F.col("batch_id").cast("long"))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _last(rows: DataFrame, keep_batch: bool = False) -> DataFrame:
    fields = [c for c in rows.columns if c not in ("window_start", "event_type", "batch_id")] + ["batch_id"] * keep_batch
    last = rows.groupBy("window_start", "event_type").agg(F.max_by(F.struct(*fields), "batch_id").alias("m"))
    return last.select("window_start", "event_type", "m.*")


def read_metrics(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """The last emitted row of each (window_start, event_type), as the last merge's commit, or commit `at`, and later batches have it."""
    return with_revenue(_last(_snapshot(spark, path, _metrics_log(spark, path).state(at)[1])))


def start_metrics(events: DataFrame, path: str, checkpoint: str, window: str = "1 minute", watermark: str = "2 minutes", every: str | None = "10 seconds", served: str | None = None) -> StreamingQuery:
    """Windowed metrics in update mode; every: the trigger's interval, None for all that is there and then stop; served: see write_metrics."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    out = windowed_metrics(events, window, watermark).writeStream.outputMode("update").foreachBatch(write_metrics(path, served, retain=1))
    return out.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def contract_events(messages: DataFrame, run_id: str, ingested_at: datetime) -> DataFrame:
    """Messages through the batch contract, with the reason where they break it; unreadable ones keep their text in raw_message."""
    rows = decode_all(messages)
    kept = ev.normalize(rows, run_id, ingested_at, extra=("value", "decode_error"))
    key = F.when(F.col("decode_error").isNotNull(), F.sha2("value", 256)).otherwise(F.col("event_key"))
    kept = kept.withColumn("event_key", key).withColumn("rejection_reason", F.coalesce("decode_error", ev.rejection_reason()))
    return kept.withColumnRenamed("value", "raw_message").drop("decode_error")


def start_index(messages: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Documents of the raw-event index (id, document), each micro-batch in a folder of its own; a batch delivered again replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        ev.index_documents(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return decode(messages).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def publish(events: DataFrame, path: str | None = None, format: str = "json", **options: str) -> None:  # noqa: A002
    """Events as wire messages (key, value) to a sink of any format; for kafka give its options and no path."""
    writer = ev.to_wire(events).write.format(format).options(**options).mode("append")
    writer.save(path) if path else writer.save()


def start_raw(messages: DataFrame, path: str, dead: str, checkpoint: str, run_id: str, ingested_at: datetime, watermark: str = "2 minutes", every: str | None = "10 seconds") -> StreamingQuery:
    """Each valid event once (by content key, within the watermark) to `path`, rejects as dead letters to `dead`."""
    rows = contract_events(messages, run_id, ingested_at).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_key"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.filter("rejection_reason IS NULL").drop("rejection_reason", "raw_message").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        ev.dead_letters(batch.filter("rejection_reason IS NOT NULL"), "events").write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_prices(raw: DataFrame, path: str, dead: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Price snapshots that keep their contract to `path`, the others as dead letters to `dead`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = pr.split_prices(pr.normalize_prices(batch))
        good.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        ev.dead_letters(bad, "prices").write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
