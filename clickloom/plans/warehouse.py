"""The batch job: raw files to bronze, silver and gold, behind the quality gate; and the daily series job."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import marts, quality, series, star
from ..sources import files, sinks
from ..sources.commits import Conflict, Folder

RUN = "run_id string, status string, source_path string, started_at timestamp, completed_at timestamp, bronze_rows long, silver_rows long, rejected_rows long, gold_rows long, error_message string"
TRIES = 5


def run_warehouse(spark: SparkSession, source: str, base: str, run_id: str | None = None, jdbc: tuple[str, dict[str, str]] | None = None, incremental: bool = False) -> dict:
    """One ingestion. Gold's partitions go into folders of this run, which count from one commit at the end on.

    Marts are built from all of silver or, if incremental and something is published, only for the days that runs not yet
    published touch (this one, and earlier ones that failed after silver). Both give the same rows; what an incremental
    run reads and writes doesn't grow with history. If another job publishes meanwhile, gold is built again on top of it.
    """
    run_id, started = run_id or uuid.uuid4().hex, datetime.now(timezone.utc)
    report: dict = {"run_id": run_id, "status": "RUNNING", "source_path": source}

    def note(error: str | None = None) -> None:
        done = None if report["status"] == "RUNNING" else datetime.now(timezone.utc)
        row = (run_id, report["status"], source, started, done, *(report.get(k) for k in ("bronze_rows", "silver_rows", "rejected_rows", "gold_rows")), error and error[:4000])
        sinks.audit(spark.createDataFrame([row], RUN), base, "pipeline_run")

    note()
    try:
        raw = files.read_raw(spark, source)
        report["bronze_rows"] = sinks.write_bronze(raw, base, run_id, started)
        valid, rejected = ev.split(ev.normalize(raw, run_id, started))
        report["silver_rows"], report["rejected_rows"] = sinks.write_silver(valid, rejected, base, run_id, report["bronze_rows"])
        for attempt in range(TRIES):
            try:
                report["gold_rows"] = publish(spark, base, run_id, attempt, incremental)
                break
            except Conflict:
                if attempt == TRIES - 1:
                    raise
        if jdbc:
            for name in marts.MARTS:
                sinks.write_jdbc(sinks.read_mart(spark, base, name), jdbc[0], f"staging.{name}", jdbc[1])
        report["status"] = "SUCCESS"
        note()
    except Exception as e:
        report["status"] = "FAILED"
        note(str(e))
        raise
    return report


def publish(spark: SparkSession, base: str, run_id: str, attempt: int = 0, incremental: bool = True) -> int:
    """Brings gold up to all committed silver, behind the gate, and returns the fact rows written; Conflict if another job published first."""
    log = sinks.gold_log(spark, base)
    number, gold = log.state()
    _, silver = sinks.silver_log(spark, base).state()
    folders = silver["tables"].get("events", {})
    incremental = incremental and number > 0
    pending = sorted(run for run in silver["runs"] if not incremental or run not in gold["runs"])
    days = {k.split("/")[0] for k in folders if k.split("/")[1] in pending}
    change: dict = {"runs": pending, "notes": {"version": run_id}, "set": {}, "schemas": {}, "drop": {}, "reset": [] if incremental else [*gold["tables"]]}
    rows = 0
    if days or not incremental:
        name = f"{run_id}-{attempt}" if attempt else run_id
        held: list[DataFrame] = []
        canonical = sinks.read_current(spark, base, [k for k in folders if k.split("/")[0] in days], held=held)
        try:
            dims = star.dimensions(canonical)
            results = quality.checks(canonical, dims).persist()
            sinks.audit(results.withColumn("run_id", F.lit(run_id)), base, "data_quality_result")
            quality.enforce(results)
            built = {**star.dimension_parts(canonical, "event_date"), "fact_behavior_event": star.fact(canonical), **marts.marts(canonical)}
            if incremental:
                built["session_daily"] = _sessions(spark, base, canonical, pending, change["drop"], held)
            seen = Observation()
            built["fact_behavior_event"] = built["fact_behavior_event"].observe(seen, F.count(F.lit(1)).alias("n"))
            with ThreadPoolExecutor(4) as pool:  # small jobs side by side
                each = {table: pool.submit(sinks.write_parts, df, base, table, name, "date_key" if table.startswith("fact") else "event_date") for table, df in built.items()}
            change["set"] = {table: f.result() for table, f in each.items()}
            change["schemas"] = {table: df.schema.json() for table, df in built.items()}
            rows = int(seen.get["n"])
        finally:
            for df in held:
                df.unpersist()
    log.commit(number + 1, **change)
    return rows


def _sessions(spark: SparkSession, base: str, canonical: DataFrame, pending: list[str], drop: dict, held: list[DataFrame]) -> DataFrame:
    """session_daily of the days that sessions with pending events leave or enter; days left empty are dropped. What it persists is added to held.

    A session's day is that of its first event, so its events of any day are needed: silver's filters tell in which
    folders they may be, and only those are read.
    """
    is_new = F.col("run_id").isin(pending)
    ids = canonical.filter(is_new & (F.trim("session_id") != "")).select("session_id").distinct().persist()
    keys = sinks.silver_keys_with_sessions(spark, base, ids, pending)
    fresh = marts.session_daily(sinks.read_current(spark, base, keys, ids)).persist()
    held += [ids, fresh]
    was = marts.session_daily(sinks.read_current(spark, base, [k for k in keys if k.split("/")[1] not in pending], ids))
    touched = sorted({str(r.event_date) for r in fresh.select("event_date").union(was.select("event_date")).distinct().collect()})  # a row a day
    published = sinks.gold_log(spark, base).state()[1]["tables"].get("session_daily", {})
    rest = [d for d in touched if d in published]
    if rest:
        old = sinks.read_mart(spark, base, "session_daily", rest[0], rest[-1]).filter(F.col("event_date").cast("string").isin(rest))
        fresh = fresh.unionByName(old.join(ids, "session_id", "left_anti"))
    fresh = fresh.select(*marts.MART_COLUMNS["session_daily"])
    have = {str(r.event_date) for r in fresh.select("event_date").distinct().collect()}  # a row a day
    drop["session_daily"] = [d for d in touched if d not in have]
    return fresh


def run_series(spark: SparkSession, history: DataFrame, out: str, horizon: int = 7) -> dict[str, DataFrame]:
    """Forecasts, backtests and anomalies of all series, written under `out`."""
    found = series.zscore_anomalies(history)
    tables = {"predictions": series.forecast(history, horizon), "backtest": series.backtest(series.model_backtest(history)), "anomalies": found.filter("anomaly_label = 1")}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in tables}


def write_report(spark: SparkSession, report: dict, base: str) -> str:
    """A run's report as a JSON file of its own in the audit zone; its text is returned."""
    folder = Folder(spark, files.zone_uri(base, "audit", "reports"))
    text = json.dumps(report, sort_keys=True, default=str)
    folder.delete(f"{report['run_id']}.json")
    folder.create(f"{report['run_id']}.json", text)
    return text


def main(args: list[str]) -> None:
    """spark-submit entry: source and base URI; prints the run's report and keeps it."""
    spark = SparkSession.builder.appName("warehouse").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(write_report(spark, run_warehouse(spark, args[0], args[1]), args[1]))  # noqa: T201


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
