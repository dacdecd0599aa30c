"""Golden values, job behaviour, streams and plans of the clickstream part."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom.operators import events as ev
from clickloom.operators import marts, prices, quality, series, serving, star
from clickloom.plans import warehouse
from clickloom.sources import files, sinks
from clickloom.streaming import speed

AT = datetime(2024, 1, 1)
HEAD = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
ROWS = [
    ("2019-10-01 09:00:00", "view", 1001, 500, 501, "s1"), ("2019-10-01 09:01:00", "cart", 1001, 500, 501, "s1"), ("2019-10-01 09:03:00", "purchase", 1001, 500, 501, "s1"),
    ("2019-10-01 10:00:00", "view", 1002, 150, 502, "s2"), ("2019-10-01 10:02:00", "cart", 1002, 150, 502, "s2"), ("2019-10-01 11:00:00", "view", 1003, 90, 503, "s3"),
    ("2019-10-02 08:00:00", "view", 1001, 500, 504, "s4"), ("2019-10-02 08:05:00", "purchase", 1001, 500, 504, "s4"),
    ("2019-10-02 12:00:00", "view", 1002, 150, 505, "s5"), ("2019-10-02 12:02:00", "cart", 1002, 150, 505, "s5"),
]
CATEGORY = {1001: "electronics.smartphone", 1002: "electronics.audio", 1003: "apparel"}


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "events.csv"
    lines = [f"{t} UTC,{k},{p},{p // 100},{CATEGORY[p]},b{p},{price},{u},{s}" for t, k, p, price, u, s in ROWS]
    path.write_text("\n".join([HEAD, *lines]))
    return str(path)


@pytest.fixture(scope="module")
def events(spark, source):
    return ev.split(ev.normalize(files.read_raw(spark, source), "r1", AT))[0].persist()


def test_star_and_gate(spark, events):
    dims = star.dimensions(events)
    assert [events.count(), events.select("event_key").distinct().count(), star.fact(events, dims).count()] == [10, 10, 10]
    assert {n: d.count() for n, d in dims.items()} == {"dim_date": 2, "dim_category": 3, "dim_product": 3, "dim_user": 5}
    assert [r.status for r in quality.checks(events, dims).collect()] == ["PASSED"] * 5
    with pytest.raises(quality.GateError):
        quality.enforce(quality.checks(events.limit(0), {k: d.limit(0) for k, d in dims.items()}))


def test_fact_needs_no_shuffle_behind_the_gate(events):
    dims = star.dimensions(events)
    assert sorted(map(str, star.fact(events).collect())) == sorted(map(str, star.fact(events, dims).collect()))
    assert "hashpartitioning" not in star.fact(events.select("*"))._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    lost = star.orphans(events, dims | {"dim_user": dims["dim_user"].filter("source_user_id <> '501'")}).collect()
    assert {r.dimension: r.orphans for r in lost} == {"dim_user": 3, "dim_product": 0}


def test_marts(events):
    f = {str(r.event_date): r for r in marts.funnel_daily(events).collect()}
    a, b = f["2019-10-01"], f["2019-10-02"]
    assert (a.viewers, a.cart_users, a.buyers, round(a.view_to_cart_rate, 6), a.cart_to_purchase_rate, round(a.conversion_rate, 6), a.cart_abandonment_rate) == (3, 2, 1, 0.666667, 0.5, 0.333333, 0.5)
    assert (b.viewers, b.cart_users, b.buyers, b.view_to_cart_rate, b.cart_to_purchase_rate, b.conversion_rate, b.cart_abandonment_rate) == (2, 1, 1, 0.5, 1.0, 0.5, 0.0)
    assert [(r.revenue, r.purchase_events, r.buyers, r.avg_purchase_value) for r in marts.daily_revenue(events).collect()] == [(500.0, 1, 1, 500.0)] * 2
    s = {r.session_id: (r.session_outcome, r.duration_seconds) for r in marts.session_daily(events).collect()}
    assert s == {"s1": ("converted", 180), "s2": ("abandoned_cart", 120), "s3": ("browsing", 0), "s4": ("converted", 300), "s5": ("abandoned_cart", 120)}
    p = marts.product_daily(events)
    assert p.filter("event_date = '2019-10-01' AND product_id = '1001'").select("views", "cart_adds", "purchase_events", "revenue").first() == (1, 1, 1, 500.0)
    assert p.agg(F.sum("revenue")).first()[0] == marts.daily_revenue(events).agg(F.sum("revenue")).first()[0] == marts.category_daily(events).agg(F.sum("revenue")).first()[0]
    for name, m in marts.marts(events).items():
        assert m.columns == warehouse.marts.MART_COLUMNS[name]
        assert marts.detail_table(m, name, rows=1).count() == 1


def test_contract_reasons_and_variants(spark):
    rows = [
        {"event_type": "page_view", "user_id": "1", "product_id": "2", "event_time": "2019-10-01 08:30:00 UTC", "price": "1.5", "payment_method": "x"},
        {"event_type": " ADD_TO_CART ", "user_id": "1", "timestamp": 1569918600, "product_ids": ["7", "8"], "total_amount": "9", "session_id": "z", "category": "a.b"},
        {"event_type": "search", "user_id": "1", "product_id": "2", "event_time": "2019-10-01 08:30:00"}, {"event_type": "view", "user_id": "1", "product_id": "2", "event_time": "never"},
        {"event_type": "view", "product_id": "2", "event_time": "2019-10-01 08:30:00"}, {"event_type": "view", "user_id": "1", "product_id": " ", "event_time": "2019-10-01 08:30:00"},
        {"event_type": "view", "user_id": "1", "product_id": "2", "event_time": "2019-10-01 08:30:00", "price": "-5"}, {"event_type": None, "user_id": None},
        {"event_type": "view", "user_id": "1", "product_id": "2", "event_time": "2019-10-01 08:31:00", "price": "cheap"},
    ]
    raw = spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    n = ev.normalize(raw, "r", AT)
    assert "payment_method" not in n.columns and len(n.columns) == 14
    valid, rejected = ev.split(n)
    got = {(r.event_type, r.source_product_id, r.price and float(r.price), r.category_code) for r in valid.collect()}
    assert got == {("cart", "7", 9.0, "a.b"), ("view", "2", None, "unknown"), ("view", "2", 1.5, "unknown")}
    assert sorted(r.rejection_reason for r in rejected.collect()) == ["missing_event_time", "missing_product_id", "missing_user_id", "negative_price", "unsupported_event_type", "unsupported_event_type"]
    wire = [json.loads(r.value) for r in ev.to_wire(valid).collect()]
    assert any(w["event_time"].startswith("2019-10-01T08:30:00") for w in wire)
    assert json.loads(ev.dead_letters(rejected, "t").first().raw_payload)["run_id"] == "r"
    strict = ev.normalize(spark.createDataFrame([("view", " 5 ", "2", "2019-10-01", "")], "event_type string, customer_id string, product_id string, order_date string, category_code string"), "r", AT, strict_contract=True).first()
    assert (strict.source_user_id, strict.category_code, str(strict.event_date)) == ("5", "unknown", "2019-10-01")
    assert ev.index_documents(raw).filter("id IS NULL").count() == 0


def test_job_replay_and_failure(spark, source, tmp_path):
    base = str(tmp_path)
    one = warehouse.run_warehouse(spark, source, base, "run-a")
    two = warehouse.run_warehouse(spark, source, base, "run-b")
    assert [one[k] for k in ("bronze_rows", "silver_rows", "rejected_rows", "gold_rows")] == [10, 10, 0, 10] and two["gold_rows"] == 10
    assert sinks.current_version(spark, base) == "run-b"
    mart = sinks.read_mart(spark, base, "funnel_daily", "2019-10-02", "2019-10-02")
    assert mart.count() == 1 and "PartitionFilters: [isnotnull(event_date" in mart._jdf.queryExecution().toString()
    bad = tmp_path / "bad.csv"
    bad.write_text(HEAD + "\n2019-10-03 09:00:00 UTC,search,1,1,a,b,5,1,s\n")
    assert warehouse.run_warehouse(spark, str(bad), base, "run-c")["rejected_rows"] == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.run_warehouse(spark, str(tmp_path / "none.csv"), base, "run-d")
    runs = {r.run_id: r.status for r in sinks.last_runs(spark, base).collect()}
    assert runs == {"run-a": "SUCCESS", "run-b": "SUCCESS", "run-c": "SUCCESS", "run-d": "FAILED"} and sinks.current_version(spark, base) == "run-c"
    assert sinks.last_checks(spark, base).count() == 15


def test_zone_uri():
    assert files.zone_uri("s3a://lake", "gold", "x/y") == "s3a://lake/gold/x/y"
    with pytest.raises(ValueError, match="unknown zone"):
        files.zone_uri("/lake", "pewter")


def test_windowed_metrics_and_serving(spark):
    rows = [("2019-10-01 10:00:05", "view", "u1", None), ("2019-10-01 10:00:10", "view", "u2", None), ("2019-10-01 10:00:15", "purchase", "u1", 100.0), ("2019-10-01 10:00:20", "purchase", "u2", 50.0)]
    e = spark.createDataFrame(rows, "event_time string, event_type string, user_id string, price double").withColumn("event_time", F.col("event_time").cast("timestamp"))
    m = serving.with_revenue(serving.windowed_metrics(e))
    assert {r.event_type: (r.event_count, r.unique_users, r.amount) for r in m.collect()} == {"view": (2, 2, 0.0), "purchase": (2, 2, 150.0)}
    assert serving.latest_kpi(m).count() == 2 and serving.revenue_series(m).first().revenue == 150.0


def _wire(t, kind, user, price=None, product="p"):
    return json.dumps({"event_time": f"2019-10-01 {t}", "event_type": kind, "user_id": user, "product_id": product, "price": price})


def test_stream_late_rows_restart_and_dead_letters(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()

    def feed(name, *lines):
        (tmp_path / "in" / name).write_text("\n".join(lines))
        e = files.decode(files.read_stream(spark, "text", src))
        speed.start_metrics(e, out, cp, every=None).awaitTermination()

    feed("1.txt", _wire("10:00:01", "view", "a"), _wire("10:00:30", "purchase", "a", 5.0), "not json")
    feed("2.txt", _wire("10:30:00", "view", "b"))
    feed("3.txt", _wire("10:00:40", "view", "late"), _wire("10:30:30", "view", "c"))
    got = {(str(r.window_start), r.event_type): r.event_count for r in speed.read_metrics(spark, out).collect()}
    assert got == {("2019-10-01 10:00:00", "view"): 1, ("2019-10-01 10:00:00", "purchase"): 1, ("2019-10-01 10:30:00", "view"): 2}
    again = spark.read.parquet(f"{out}/batch_id=0")
    speed.write_metrics(out)(spark.createDataFrame(again.collect(), again.schema), 0)  # delivered again
    assert speed.read_metrics(spark, out).count() == 3

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "1.txt").write_text("\n".join([_wire("10:00:01", "view", "a"), _wire("10:00:01", "view", "a"), _wire("10:00:02", "search", "a")]))
    args = (files.read_stream(spark, "text", str(tmp_path / "raw")), str(tmp_path / "good"), str(tmp_path / "dead"), str(tmp_path / "cp2"), "r", AT)
    speed.start_raw(*args, every=None).awaitTermination()
    assert spark.read.parquet(args[1]).count() == 1 and spark.read.parquet(args[2]).first().error == "unsupported_event_type"


def test_prices(spark):
    payload = {"data": [
        {"id": 1, "name": "a", "price": 10.0, "list_price": 0, "original_price": 12.0, "brand_name": "b", "url_key": "k", "seller_id": 1, "availability": 1, "shippable": True},
        {"id": 2, "name": "c", "price": 5.0, "availability": 0}, {"id": None, "name": "d", "price": 1.0},
    ]}
    pages = spark.read.schema(prices.LISTING_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(payload)]))
    listed = prices.from_listing(pages, "cat", "https://shop.example/%s-%s").withColumn("site", F.lit(" Shop "))
    good, bad = prices.split_prices(prices.normalize_prices(listed))
    got = {r.product_id: r for r in good.collect()}
    assert (got["1"].list_price, got["1"].seller_name, got["1"].url, got["1"].site, got["1"].currency, got["1"].in_stock, got["2"].in_stock) == (12.0, "seller:1", "https://shop.example/k-1", "shop", "VND", True, False)
    assert [r.rejection_reason for r in bad.collect()] == ["missing_product_id"]


def test_landed_folders_do_not_grow_with_sites(spark, tmp_path):
    rows = spark.range(600).select(F.concat(F.lit("site"), F.col("id") % 300).alias("site"), F.col("id").cast("string").alias("product_id"), F.expr("CASE WHEN id < 590 THEN TIMESTAMP'2019-10-01 10:00:00' + make_dt_interval(CAST(id % 2 AS INT)) END").alias("snapshot_time"))
    for _ in range(2):
        sinks.write_snapshots(rows, str(tmp_path))
    place = tmp_path / "bronze" / "prices"
    assert sorted(p.name for p in place.iterdir() if p.is_dir()) == ["run_date=2019-10-01", "run_date=2019-10-02", "run_date=__HIVE_DEFAULT_PARTITION__"] and len(list(place.rglob("*.parquet"))) <= 12
    back = spark.read.parquet(str(place))
    assert sorted(map(str, back.select(*rows.columns).collect())) == sorted(map(str, rows.union(rows).collect())) and back.filter("site = 'site7' AND run_date = '2019-10-02'").count() == 4


def test_series(spark):
    h = spark.sql("SELECT 'all' AS series, date_add(DATE'2019-10-01', i) AS date, 10.0D + i AS revenue, CAST(i AS BIGINT) AS purchase_events, 1.0D AS avg_purchase_value FROM (SELECT explode(sequence(0, 19)) AS i)")
    f = series.naive_forecast(h).collect()
    assert len(f) == 7 and {r.predicted_revenue for r in f} == {26.0} and str(min(r.forecast_date for r in f)) == "2019-10-21"
    d = sorted(series.backtest_detail(h, holdout=5).collect(), key=lambda r: r.fold)
    assert [r.mae for r in d] == [5.0, 6.0, 6.0]
    b = series.backtest(series.backtest_detail(h, holdout=5)).first()
    assert round(b.mae, 6) == 5.666667 and b.folds == 3
    assert series.backtest_detail(h.limit(4)).count() == 0
    many = series.forecast(h.union(h.withColumn("series", F.lit("b")))).collect()
    assert len(many) == 2 * 3 * 7 and all(r.predicted_revenue >= 0 for r in many)
    assert len(series.forecast(h, models={"broken": lambda y, d, a: 1 / 0}).collect()) == 7
    odd = h.limit(9).union(spark.sql("SELECT 'all', DATE'2020-01-01', 1000.0D, 10L, 100.0D"))
    for g in (series.zscore_anomalies, series.pca_anomalies):
        labels = [r.anomaly_label for r in g(odd, 0.1).collect()]
        assert set(labels) == {0, 1}
    assert series.stability(odd).count() == 10 and series.calendar_covariates(h).count() == 80


def test_no_python_in_core_plans(spark, events):
    for m in marts.marts(events).values():
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_incremental_marts_equal_a_rebuild(spark, source, tmp_path):
    """A second run that adds events to an old day, moves a session's start back a day and leaves a day of one session empty."""
    more = tmp_path / "more.csv"
    head = Path(source).read_text().split("\n")[0]
    row = {c: "" for c in head.split(",")}
    late = [row | {"event_time": "2019-10-01 23:50:00 UTC", "event_type": "view", "product_id": "1002", "user_id": "505", "user_session": "s5", "price": "150.00"},
            row | {"event_time": "2019-10-03 01:00:00 UTC", "event_type": "purchase", "product_id": "1003", "user_id": "503", "user_session": "s9", "price": "90.00"}]
    more.write_text("\n".join([head, *(",".join(x.values()) for x in late)]) + "\n")
    bases = [str(tmp_path / k) for k in ("inc", "full")]
    for base, incremental in zip(bases, (True, False), strict=True):
        for k, path in enumerate((str(source), str(more))):
            warehouse.run_warehouse(spark, path, base, f"run-{k}", incremental=incremental)
    for name in marts.MARTS:
        a, b = (sorted(map(str, sinks.read_mart(spark, base, name).collect())) for base in bases)
        assert a == b and a
    days = {r.session_id: str(r.event_date) for r in sinks.read_mart(spark, bases[0], "session_daily").collect()}
    assert days["s5"] == "2019-10-01" and days["s9"] == "2019-10-03"


def test_unreadable_messages_and_served_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join([_wire("10:00:01", "view", "a"), "not json", '{"event_time": "2019-10-01 10:00:00"}', _wire("nonsense", "view", "a"), _wire("10:00:09", "purchase", "a", -1.0)]))
    stream = lambda: files.read_stream(spark, "text", str(tmp_path / "in"))
    speed.start_raw(stream(), str(tmp_path / "good"), str(tmp_path / "dead"), str(tmp_path / "cp"), "r", AT, every=None).awaitTermination()
    dead = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert sorted(r.error for r in dead) == ["negative_price", "no_event_type", "not_json", "unreadable_time"]
    assert json.loads(next(r.raw_payload for r in dead if r.error == "not_json"))["raw_message"] == "not json"
    out, served = str(tmp_path / "metrics"), str(tmp_path / "served")
    write = speed.write_metrics(out, served, compact_every=2)
    for k, (minute, n) in enumerate([("10:00", 1), ("10:05", 2), ("10:05", 3), ("10:02", 9)]):
        write(spark.sql(f"SELECT TIMESTAMP'2019-10-01 {minute}:00' AS window_start, TIMESTAMP'2019-10-01 {minute}:59' AS window_end, 'purchase' AS event_type, {n}L AS event_count, 1L AS unique_users, {n}D AS amount"), k)
    assert [r.event_count for r in speed.read_served(spark, served, "kpi").collect()] == [3]
    assert [r.revenue for r in speed.read_served(spark, served, "revenue_series").collect()] == [3.0, 9.0, 1.0]
    assert sorted(r.event_count for r in speed.read_metrics(spark, out).collect()) == [1, 3, 9]
    assert sorted(p.name for p in Path(out).iterdir() if p.name.startswith("batch")) == ["batch_id=2", "batch_id=3"]


def test_every_model_is_backtested(spark):
    h = spark.sql("SELECT 'all' AS series, date_add(DATE'2019-10-01', i) AS date, 10.0D + i AS revenue, CAST(i AS BIGINT) AS purchase_events, 1.0D AS avg_purchase_value FROM (SELECT explode(sequence(0, 19)) AS i)")
    b = {r.model: r for r in series.backtest(series.model_backtest(h, holdout=5)).collect()}
    assert set(b) == set(series.FORECASTERS) and round(b["naive7"].mae, 6) == 5.666667 and round(b["seasonal_naive"].mae, 6) == 6.333333  # of 5, 7 and 7
    assert series.model_backtest(h.limit(4)).count() == 0
