"""Writing and reading zones: bronze, silver with its index of sessions, gold as folders that commits name; audit tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..contract import MART_COLUMNS
from ..operators import events as ev
from ..operators import star
from . import key_index
from .commits import CommitLog, Folder
from .files import zone_uri


def _append(df: DataFrame, path: str, *by: str) -> int:
    """Appends and returns the number of rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(*by).parquet(path)
    return int(seen.get["n"])


def write_bronze(raw: DataFrame, base: str, run_id: str, ingested_at: datetime) -> int:
    at = F.lit(ingested_at).cast("timestamp")
    marked = raw.withColumns({"_run_id": F.lit(run_id), "_ingested_at": at, "_ingest_date": F.to_date(at)})
    return _append(marked, zone_uri(base, "bronze", "events"), "_ingest_date", "_run_id")


SILVER = ["event_date", "run_id", "shard"]
SHARD_ROWS = 2_000_000


def silver_log(spark: SparkSession, base: str) -> CommitLog:
    return CommitLog(spark, zone_uri(base, "silver", "_log"))


def gold_log(spark: SparkSession, base: str) -> CommitLog:
    return CommitLog(spark, zone_uri(base, "gold", "_log"))


def write_silver(valid: DataFrame, rejected: DataFrame, base: str, run_id: str = "", rows: int = 0) -> tuple[int, int]:
    """Valid events by day, run and shard (of session hashes, about SHARD_ROWS of `rows` each), a filter of each folder's sessions, and rejects.

    The folders count from the commit at the end on: what a broken write left behind is never read. A note tells whether
    they hold the rows of this write alone, one of each key. Shards are odd in number, as filters' blocks are powers of two.
    """
    spark, shards = valid.sparkSession, min(256, rows // SHARD_ROWS + 1) | 1
    shard = key_index.shard_name(F.xxhash64(F.coalesce("session_id", F.lit(""))), F.lit(shards))
    n = _append(valid.withColumn("shard", shard).repartition("event_date", "shard"), zone_uri(base, "silver", "events"), *SILVER)
    bad = _append(rejected, zone_uri(base, "silver", "quarantine"), "run_id")
    if not n:
        silver_log(spark, base).append(runs=[run_id])
        return n, bad
    schema = StructType([*valid.drop("event_date", "run_id").schema.fields, StructField("event_date", DateType()), StructField("run_id", StringType()), StructField("shard", StringType())])
    written = spark.read.schema(schema).option("basePath", zone_uri(base, "silver", "events")).parquet(f"{zone_uri(base, 'silver', 'events')}/event_date=*/run_id={run_id}")
    index = key_index.filters(written.filter("trim(session_id) <> ''"), "session_id", SILVER)
    index.write.mode("overwrite").parquet(f"{zone_uri(base, 'silver', '_sessions')}/of={run_id}")
    found = written.groupBy(*SILVER).agg(F.count("*").alias("n")).collect()  # a row a folder
    folders = {f"{r.event_date}/{r.run_id}/{r.shard}": r.n for r in found}
    silver_log(spark, base).append(runs=[run_id], set={"events": folders}, schemas={"events": schema.json()}, notes={f"unique {run_id}": sum(folders.values()) == n})
    return n, bad


def _silver_path(base: str, key: str) -> str:
    parts = zip(SILVER, key.split("/"), strict=True)
    return "/".join([zone_uri(base, "silver", "events"), *(f"{c}={v}" for c, v in parts)])


def read_silver(spark: SparkSession, base: str, keys: list[str] | None = None) -> DataFrame:
    """Committed silver: all of it, or the folders named by keys `day/run/shard`; the others aren't listed."""
    _, state = silver_log(spark, base).state()
    have = state["tables"].get("events", {})
    keys = sorted(have if keys is None else [k for k in keys if k in have])
    if "events" not in state["schemas"]:
        raise ValueError(f"no silver events under {base}")
    schema = StructType.fromJson(json.loads(state["schemas"]["events"]))
    if not keys:
        return spark.createDataFrame([], schema).drop("shard")
    reader = spark.read.schema(schema).option("basePath", zone_uri(base, "silver", "events"))
    return reader.parquet(*(_silver_path(base, k) for k in keys)).drop("shard")


def read_current(spark: SparkSession, base: str, keys: list[str], only: DataFrame | None = None, held: list[DataFrame] | None = None) -> DataFrame:
    """The row of each event key that was ingested last, of the silver folders named by keys; only: of these sessions.

    A key's rows share a day, and a run's folders hold it once: only days that several runs brought are deduplicated.
    held: a list to which what was deduplicated is added, persisted.
    """
    _, state = silver_log(spark, base).state()
    runs: dict[str, set[str]] = {}
    for k in keys:
        runs.setdefault(k.split("/")[0], set()).add(k.split("/")[1])
    clean = {day for day, of in runs.items() if len(of) == 1 and state["notes"].get(f"unique {next(iter(of))}")}
    parts = [[k for k in keys if (k.split("/")[0] in clean) == once] for once in (True, False)]
    rows = [read_silver(spark, base, p) for p in parts]
    if only is not None:
        rows = [r.join(only, "session_id", "left_semi").select(*r.columns) for r in rows]
    if not parts[1]:
        return rows[0]
    once = ev.latest(rows[1])
    if held is not None:
        held.append(once.persist())
    return rows[0].unionByName(once) if parts[0] else once


def silver_keys_with_sessions(spark: SparkSession, base: str, sessions: DataFrame, known: list[str] | None = None) -> list[str]:
    """The silver folders that hold events of any of the sessions, by the filters of all committed runs; a few others may be among them.

    known: runs that all sessions come from; their folders are taken without a look.
    """
    _, state = silver_log(spark, base).state()
    have = state["tables"].get("events", {})
    taken = [k for k in have if k.split("/")[1] in (known or [])]
    paths = [f"{zone_uri(base, 'silver', '_sessions')}/of={run}" for run in sorted({k.split("/")[1] for k in have} - set(known or []))]
    if not paths:
        return taken
    index = spark.read.parquet(*paths)
    found = key_index.folders_with(sessions, "session_id", index, SILVER, "shard").collect()  # a row a folder
    return taken + [k for r in found if (k := f"{r.event_date}/{r.run_id}/{r.shard}") in have]


def write_parts(df: DataFrame, base: str, table: str, run: str, by: str = "event_date") -> dict[str, str]:
    """Writes a gold table's partitions to folders of this run, in few files each; the folder of each value of `by`, below the table's own."""
    path = f"{zone_uri(base, 'gold', table)}/run={run}"
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    names = [n for n in Folder(df.sparkSession, path).names() if n.startswith(f"{by}=")]
    return {n.removeprefix(f"{by}="): f"run={run}/{n}" for n in names}


def current_version(spark: SparkSession, base: str) -> str | None:
    """The run published last; None before the first."""
    return gold_log(spark, base).state()[1]["notes"].get("version")


def read_gold(spark: SparkSession, base: str, table: str, date_from: str | None = None, date_to: str | None = None, at: int | None = None) -> DataFrame:
    """A gold table as one commit has it: the last, or commit `at`. Days outside the bounds aren't listed."""
    _, state = gold_log(spark, base).state(at)
    if table not in state["schemas"]:
        raise ValueError(f"no gold table {table} under {base}")
    by, schema = ("date_key" if table.startswith("fact") else "event_date"), StructType.fromJson(json.loads(state["schemas"][table]))
    day = lambda k: k.replace("-", "")  # noqa: E731  both kinds of keys, as text
    paths = [p for k, p in sorted(state["tables"].get(table, {}).items()) if (not date_from or day(k) >= day(date_from)) and (not date_to or day(k) <= day(date_to))]
    kind = schema[by]
    schema = StructType([*(f for f in schema.fields if f.name != by), StructField("run", StringType()), kind])
    if not paths:
        return spark.createDataFrame([], schema).drop("run")
    root = zone_uri(base, "gold", table)
    df = spark.read.schema(schema).option("basePath", root).parquet(*(f"{root}/{p}" for p in paths)).drop("run")
    for bound, keep in ((date_from, F.col(by) >= F.lit(date_from and day(date_from) if by == "date_key" else date_from).cast(kind.dataType)), (date_to, F.col(by) <= F.lit(date_to and day(date_to) if by == "date_key" else date_to).cast(kind.dataType))):
        df = df.filter(keep) if bound else df
    return df


def read_mart(spark: SparkSession, base: str, name: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """A published mart in its contract's column order; the date bounds prune partitions."""
    return read_gold(spark, base, name, date_from, date_to).select(*MART_COLUMNS[name])


def read_dimension(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A dimension, merged from the parts of all days."""
    if name == "dim_date":
        days = read_gold(spark, base, "dim_user").select(F.col("event_date").alias("d")).distinct()
        return star.calendar(days)
    return star.merged(name, read_gold(spark, base, name))


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Removes gold folders that none of the last `keep` commits names: those of runs that failed or were replaced. Returns their paths."""
    log = gold_log(spark, base)
    states = [log.state(n)[1] for n in log.numbers()[-keep:]]
    gone = []
    for table in {t for s in states for t in s["tables"]}:
        used = {p for s in states for p in s["tables"].get(table, {}).values()}
        root = Folder(spark, zone_uri(base, "gold", table))
        for run in (n for n in root.names() if n.startswith("run=")):
            for part in (n for n in Folder(spark, f"{root.path}/{run}").names() if "=" in n):
                if f"{run}/{part}" not in used:
                    root.delete(f"{run}/{part}")
                    gone.append(f"{table}/{run}/{part}")
    return gone


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], partitions: int = 8) -> None:
    """A staging table in a database, written by `partitions` connections."""
    df.write.option("numPartitions", partitions).jdbc(url, table, "overwrite", properties)


def replace_table(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").parquet(path)


def audit(rows: DataFrame, base: str, table: str) -> None:
    rows.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(zone_uri(base, "audit", table))


def latest_audit(spark: SparkSession, base: str, table: str, *keys: str) -> DataFrame:
    """The last recorded row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc("recorded_at"))
    return spark.read.parquet(zone_uri(base, "audit", table)).withColumn("place", F.row_number().over(w)).filter("place = 1").drop("place")


def last_runs(spark: SparkSession, base: str, rows: int = 10) -> DataFrame:
    return latest_audit(spark, base, "pipeline_run", "run_id").orderBy(F.desc("started_at"), "run_id").limit(rows)


def last_checks(spark: SparkSession, base: str, rows: int = 50) -> DataFrame:
    return latest_audit(spark, base, "data_quality_result", "run_id", "check_name").orderBy(F.desc("recorded_at"), "check_name").limit(rows)


def write_snapshots(snapshots: DataFrame, base: str) -> None:
    """Price snapshots in folders by day, sorted by site in their files: folders don't grow with the number of sites, and a site's rows are found by the files' statistics."""
    rows = snapshots.withColumn("run_date", F.to_date("snapshot_time")).hint("rebalance", "run_date").sortWithinPartitions("run_date", "site")
    rows.write.mode("append").partitionBy("run_date").parquet(zone_uri(base, "bronze", "prices"))


def create_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def drop_views(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)
