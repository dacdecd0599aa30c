"""Commits, the key index, incremental gold after failures and beside other writers, and merges of stream metrics."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom.operators import marts, quality
from clickloom.plans import warehouse
from clickloom.sources import commits, key_index, sinks
from clickloom.streaming import speed

HEAD = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def csv(path, *rows):
    path.write_text("\n".join([HEAD, *rows]) + "\n")
    return str(path)


def event(day, clock, kind="view", product=1, user=1, session="s1", price=5):
    return f"2019-10-{day:02d} {clock} UTC,{kind},{product},1,a.b,x,{price},{user},{session}"


def gold(spark, base):
    tables = {n: sinks.read_mart(spark, base, n) for n in marts.MARTS} | {n: sinks.read_dimension(spark, base, n) for n in ("dim_user", "dim_product", "dim_category", "dim_date")}
    tables["fact"] = sinks.read_gold(spark, base, "fact_behavior_event").drop("source_file", "ingested_at")
    return {n: sorted(str(r.asDict()) for r in df.select(*sorted(df.columns)).collect()) for n, df in tables.items()}


def size(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*") if p.is_file())


def test_commits_are_taken_once_and_readers_see_one_state(spark, tmp_path):
    log, other = (commits.CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert log.state() == (0, {"tables": {}, "schemas": {}, "runs": {}, "notes": {}})
    number, _ = log.state()
    other.commit(1, set={"t": {"a": "x", "b": "y"}}, runs=["r1"])
    with pytest.raises(commits.Conflict):
        log.commit(number + 1, set={"t": {"a": "lost"}})
    assert log.append(drop={"t": ["b"]}, set={"t": {"c": "z"}}, notes={"k": 1}) == 2
    assert log.state(1)[1]["tables"] == {"t": {"a": "x", "b": "y"}} and other.state()[1]["tables"] == {"t": {"a": "x", "c": "z"}}
    (tmp_path / "log" / f"{3:020d}.json").write_text("")  # a writer that isn't done
    assert log.state()[0] == 2
    for _ in range(commits.KEEP):
        log.append(reset=["t"], set={"t": {"d": "w"}})
    (tmp_path / "log" / f"{4:020d}.json").unlink()  # readers start from the whole state
    assert log.state()[1]["tables"] == {"t": {"d": "w"}} and log.state()[1]["runs"].keys() == {"r1"}


def test_filters_find_every_folder_and_few_more(spark):
    rows = spark.range(40000).select((F.col("id") % 8).alias("f"), F.concat(F.lit("k"), "id").alias("k")).union(spark.sql("SELECT 9L, CAST(NULL AS STRING)"))
    index = key_index.filters(rows, "k", ["f"]).persist()
    assert index.select("blocks").distinct().collect()[0][0] == 8
    probe = spark.createDataFrame([("k3",), ("k11",), ("k21",), (None,)], "k string")
    assert {r.f for r in key_index.folders_with(probe, "k", index, ["f"]).collect()} == {3, 5}
    strange = spark.range(20000).select(F.concat(F.lit("z"), "id").alias("k"))
    hashed = strange.withColumn("one", F.col("k"))
    wrong = sum(len(key_index.folders_with(hashed.filter(F.col("k").endswith(str(d))), "k", index, ["f"]).collect()) for d in range(2))
    assert wrong <= 2
    assert key_index.folders_with(probe, "k", index.limit(0), ["f"]).count() == 0


def test_keys_meet_filters_of_their_shard_only(spark):
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")).withColumn("s", key_index.shard_name(F.xxhash64("k"), F.lit(3)))
    all_in_one = rows.withColumn("s", F.lit("0-3"))
    for df, want in ((rows, {"0-3", "1-3", "2-3"}), (all_in_one.union(rows.withColumn("s", F.lit("0-1"))), {"0-3", "0-1"})):
        assert {r.s for r in key_index.folders_with(rows, "k", key_index.filters(df, "k", ["s"]), ["s"], "s").collect()} == want
    strange = rows.filter("s <> '0-3'")  # in a folder of another shard these aren't looked for
    assert key_index.folders_with(strange, "k", key_index.filters(all_in_one, "k", ["s"]), ["s"], "s").count() == 0


def test_a_day_has_few_files_and_events_of_one_run_are_not_shuffled_again(spark, tmp_path):
    base = str(tmp_path / "b")
    days = spark.range(6000).repartition(40).select("id", F.expr("date_add(DATE'2019-10-01', CAST(id % 3 AS INT))").alias("event_date"))
    sinks.write_parts(days, base, "t", "r")
    assert len(list(Path(base).rglob("*.parquet"))) <= 6
    rows = [event(d, f"09:{m:02d}:00", "view", m, m, f"s{m}") for d in (1, 2) for m in range(20)]
    warehouse.run_warehouse(spark, csv(tmp_path / "1.csv", *rows), base, "run-1")
    shuffles = lambda: sinks.read_current(spark, base, [*sinks.silver_log(spark, base).state()[1]["tables"]["events"]])._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert shuffles() == 0
    once = gold(spark, base)
    warehouse.run_warehouse(spark, str(tmp_path / "1.csv"), base, "run-1")  # the run's folders hold every key twice now
    assert shuffles() > 0 and len(gold(spark, base)["fact"]) == 40 and gold(spark, base) == once


def test_days_of_a_failed_run_are_made_up_for(spark, tmp_path, monkeypatch):
    paths = [csv(tmp_path / f"{i}.csv", event(i, "09:00:00", "purchase", i, i, f"s{i}"), event(i, "10:00:00", "view", 1, 1, "all")) for i in (1, 2, 3)]
    bases = [str(tmp_path / n) for n in ("inc", "full")]
    warehouse.run_warehouse(spark, paths[0], bases[0], "run-a", incremental=True)
    with monkeypatch.context() as m:
        m.setattr(quality, "enforce", lambda results: (_ for _ in ()).throw(quality.GateError("broken")))
        with pytest.raises(quality.GateError):
            warehouse.run_warehouse(spark, paths[1], bases[0], "run-b", incremental=True)
    before = gold(spark, bases[0])
    assert len(before["daily_revenue"]) == 1
    warehouse.run_warehouse(spark, paths[2], bases[0], "run-c", incremental=True)
    for i, path in enumerate(paths):
        warehouse.run_warehouse(spark, path, bases[1], f"run-{'abc'[i]}")
    after, rebuilt = gold(spark, bases[0]), gold(spark, bases[1])
    assert after == rebuilt and len(after["daily_revenue"]) == 3
    assert sinks.read_gold(spark, bases[0], "fact_behavior_event", at=1).count() == 2  # readers of the old commit lose nothing
    gone = sinks.vacuum(spark, bases[1], keep=1)
    assert gone and gold(spark, bases[1]) == rebuilt


def test_an_incremental_run_reads_and_writes_what_it_touches(spark, tmp_path):
    """Ten days of history or thirty: a run of one day reads and writes as much; a redelivered event takes its new price."""
    wrote, listed = [], []
    for days in (4, 12):
        base = str(tmp_path / f"base{days}")
        rows = [event(d, f"09:{m:02d}:00", "view", m, d * 100 + m, f"s{d}-{m}") for d in range(1, days + 1) for m in range(20)]
        warehouse.run_warehouse(spark, csv(tmp_path / f"h{days}.csv", *rows), base, "run-0")
        before, silver = size(f"{base}/gold"), sinks.read_silver(spark, base).inputFiles()
        new = csv(tmp_path / f"n{days}.csv", event(20, "09:00:00", "purchase", 3, 7, "s1-3"), event(1, "09:04:00", "view", 4, 104, "s1-4", price=9))
        warehouse.run_warehouse(spark, new, base, "run-1", incremental=True)
        wrote.append(size(f"{base}/gold") - before)
        ids = spark.createDataFrame([("s1-3",), ("s1-4",)], "session_id string")
        keys = sinks.silver_keys_with_sessions(spark, base, ids)
        listed.append(len(sinks.read_silver(spark, base, keys).inputFiles()))
        assert {k.split("/")[0] for k in keys} == {"2019-10-01", "2019-10-20"} and len(silver) >= days > listed[-1] - 1
        warehouse.run_warehouse(spark, csv(tmp_path / "none.csv"), base, "run-2")  # a rebuild
        full = gold(spark, base)
        at = [n for n in sinks.gold_log(spark, base).numbers()][-2]
        for name in marts.MARTS:
            inc = sinks.read_gold(spark, base, name, at=at).select(*marts.MART_COLUMNS[name])
            assert sorted(str(r.asDict()) for r in inc.select(*sorted(inc.columns)).collect()) == full[name]
        day = sinks.read_gold(spark, base, "fact_behavior_event", "2019-10-01", "2019-10-01", at)
        assert sorted(float(r.price) for r in day.filter("session_id = 's1-4'").collect()) == [9.0]
    assert abs(wrote[0] - wrote[1]) < 0.05 * wrote[0] and listed[0] == listed[1]


def test_of_two_jobs_one_tries_again(spark, tmp_path, monkeypatch):
    base, publish, raced = str(tmp_path / "b"), warehouse.publish, []
    one, two = (csv(tmp_path / f"{i}.csv", event(i, "09:00:00", "view", i, i, f"s{i}")) for i in (1, 2))

    def slow(spark_, base_, run_id, attempt=0, incremental=True):
        real = sinks.CommitLog.commit

        def late(log, number, **change):
            if not raced and change.get("notes"):
                raced.append(run_id)
                monkeypatch.setattr(sinks.CommitLog, "commit", real)
                warehouse.run_warehouse(spark, two, base, "run-2", incremental=True)  # publishes in between
            return real(log, number, **change)

        monkeypatch.setattr(sinks.CommitLog, "commit", late if not raced else real)
        return publish(spark_, base_, run_id, attempt, incremental)

    monkeypatch.setattr(warehouse, "publish", slow)
    warehouse.run_warehouse(spark, one, base, "run-1", incremental=True)
    assert raced == ["run-1"] and sinks.current_version(spark, base) == "run-1" and sinks.gold_log(spark, base).numbers() == [1, 2]
    assert sinks.read_mart(spark, base, "funnel_daily").count() == 2
    assert {r.run_id: r.status for r in sinks.last_runs(spark, base).collect()} == {"run-1": "SUCCESS", "run-2": "SUCCESS"}


def metric(spark, minute, n, kind="purchase"):
    return spark.sql(f"SELECT TIMESTAMP'2019-10-01 {minute}:00' AS window_start, TIMESTAMP'2019-10-01 {minute}:59' AS window_end, '{kind}' AS event_type, {n}L AS event_count, 1L AS unique_users, {n}D AS amount")


def counts(spark, out, at=None):
    return sorted((str(r.window_start)[11:16], r.event_count) for r in speed.read_metrics(spark, out, at).collect())


@pytest.mark.parametrize("broken", [None, "commit", "delete"])
def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path, monkeypatch, broken):
    """The last batch comes again after a merge that ended, or that broke before or after its commit."""
    out, batches = str(tmp_path / "m"), [metric(spark, m, n) for m, n in (("10:00", 1), ("10:05", 2), ("10:05", 3), ("10:09", 4), ("10:00", 9))]
    write, want = speed.write_metrics(out, compact_every=2), [("10:00", 1), ("10:05", 3)]
    for k in (0, 1):
        write(batches[k], k)
    if broken:
        with monkeypatch.context() as m:
            m.setattr(*((speed.CommitLog, "commit") if broken == "commit" else (speed, "_delete")), lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                write(batches[2], 2)
        assert counts(spark, out) == want
    write(batches[2], 2)
    assert counts(spark, out) == want
    write(batches[2], 2)
    assert counts(spark, out) == want
    for k in (3, 4):
        write(batches[k], k)
    assert counts(spark, out) == [("10:00", 9), ("10:05", 3), ("10:09", 4)]
    write(batches[4], 4)
    assert counts(spark, out) == [("10:00", 9), ("10:05", 3), ("10:09", 4)]
    names = sorted(p.name for p in Path(out).iterdir())
    assert [n for n in names if n.startswith("batch")] == ["batch_id=4"] and sum(n.startswith("_merged") for n in names) == 1


def test_a_reader_that_began_before_a_merge_ends(spark, tmp_path):
    out = str(tmp_path / "m")
    write = speed.write_metrics(out, compact_every=2, retain=1)
    for k in range(3):
        write(metric(spark, f"10:0{k}", k), k)
    reader = speed.read_metrics(spark, out)
    for k in (3, 4):
        write(metric(spark, f"10:0{k}", k), k)
    assert sorted(r.event_count for r in reader.collect()) == [0, 1, 2]
    assert [n for _, n in counts(spark, out)] == [0, 1, 2, 3, 4] and [n for _, n in counts(spark, out, at=1)][:2] == [0, 1]


def test_kpi_of_a_silent_type_expires(spark, tmp_path):
    out, served = str(tmp_path / "m"), str(tmp_path / "s")
    kinds = lambda: {r.event_type for r in speed.read_served(spark, served, "kpi").collect()}
    speed.write_metrics(out, served)(metric(spark, "10:00", 1, "view").union(metric(spark, "10:30", 1)), 0)
    assert kinds() == {"view", "purchase"}
    speed.write_metrics(out, served)(metric(spark, "11:00", 1), 1)  # a new writer, as after a restart
    assert kinds() == {"view", "purchase"}
    speed.write_metrics(out, served)(metric(spark, "11:01", 1), 2)
    assert kinds() == {"purchase"}
    speed.write_metrics(out, served)(metric(spark, "11:02", 1, "view"), 3)
    assert kinds() == {"view", "purchase"}
