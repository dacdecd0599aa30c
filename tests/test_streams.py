"""Session state on the stream, sketches, models, connectors."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.operators import events as ev
from clickloom.operators import learned, marts, series, sketches
from clickloom.plans import warehouse
from clickloom.sources import files, sinks
from clickloom.streaming import gate, sessions, speed

AT = datetime(2024, 1, 1)


def wire(day, clock, kind, session, product="p", user="u", price=1.0):
    return json.dumps({"event_time": f"2019-10-{day:02d} {clock}", "event_type": kind, "user_id": user, "product_id": product, "price": price, "user_session": session})


def test_sessions_of_the_stream_are_those_of_the_batch(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    feeds = [
        [wire(1, "10:00:00", "view", "a"), wire(1, "10:00:30", "cart", "a", "q"), wire(1, "10:00:00", "view", "a"), wire(1, "10:00:00", "view", "b", user="v"), "not json"],
        [wire(1, "10:01:00", "purchase", "a", "q", "other"), wire(1, "09:59:00", "view", "b", "r", "w")],  # the second is late, within the watermark
        [wire(5, "12:00:00", "view", "c")],  # the watermark passes a and b, whose state goes
        [wire(5, "12:00:01", "view", "a", "z"), wire(1, "10:02:00", "view", "b", "lost")],  # a comes back; b's row is below the watermark
    ]
    kept = []
    for i, lines in enumerate(feeds):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(lines))
        kept += [x for x in lines if "lost" not in x]
        sessions.start_sessions(files.read_stream(spark, "text", src), out, cp, "r", AT, "2 hours", 3_600_000, None).awaitTermination()
        got = sessions.read_sessions(spark, out)
        batch = speed.contract_events(spark.createDataFrame([(x,) for x in kept], "value string"), "r", AT).filter("rejection_reason IS NULL").drop("rejection_reason", "raw_message")
        want = marts.session_daily(ev.one_per_key(batch))
        rows = lambda df: sorted(str(r.asDict()) for r in df.select(*sorted(df.columns)).collect())
        assert rows(got) == rows(want)
    assert speed.last_batches(spark, out).filter("session_id = 'a'").select("fragment").distinct().count() == 2


def test_session_state_is_kept_without_python(spark, tmp_path):
    events = speed.contract_events(files.read_stream(spark, "text", str(tmp_path)), "r", AT)
    assert "Pandas" not in sessions.session_updates(events)._jdf.queryExecution().analyzed().toString()


def test_a_bad_batch_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    base, good = str(tmp_path / "b"), str(tmp_path / "good")

    def run(name, lines, share=0.5):
        (tmp_path / "in" / name).write_text("\n".join(lines))
        q = gate.start_gated(files.read_stream(spark, "text", str(tmp_path / "in")), good, str(tmp_path / "dead"), str(tmp_path / "cp"), base, "r", AT, share, every=None)
        q.awaitTermination()

    run("1.txt", [wire(1, "10:00:00", "view", "a"), "not json"])
    with pytest.raises(Exception, match=r"batch_rejected_share \(2\)"):
        run("2.txt", [wire(1, "10:01:00", "view", "a"), wire(1, "10:02:00", "search", "a"), "{}"])
    assert spark.read.parquet(good).count() == 1
    last = sinks.last_checks(spark, base).collect()
    assert {r.status for r in last if r.check_name == "batch_rejected_share"} == {"PASSED", "FAILED"}
    run("3.txt", [wire(1, "10:03:00", "view", "a")], 0.9)  # begins with the batch that failed
    assert spark.read.parquet(good).count() == 3


def test_sketches_unite(spark):
    rows = spark.range(60000).select((F.col("id") % 20000).cast("string").alias("user_id"), F.timestamp_seconds(F.lit(1569888000) + (F.col("id") % 30) * 86400).alias("event_time"), F.when(F.col("id") % 2 == 0, "view").otherwise("cart").alias("event_type"), (F.col("id") * 7919 % 60000).cast("double").alias("price"))
    kept = sketches.user_sketches(rows.union(rows.limit(1).withColumn("user_id", F.lit(None)))).persist()
    assert abs(sketches.users_over(kept).first().users - 20000) < sketches.HLL_ERROR * 20000
    for r in sketches.users_over(kept, F.date_trunc("week", "bucket").alias("week")).join(rows.groupBy(F.date_trunc("week", "event_time").alias("week")).agg(F.count_distinct("user_id").alias("n")), "week").collect():
        assert abs(r.users - r.n) < sketches.HLL_ERROR * r.n
    values = sketches.value_sketches(rows, "price", "event_type", F.to_date("event_time").alias("day")).persist()
    q = sketches.quantiles_over(values, {"a": 0.25, "b": 0.75}).first()
    assert q.n == 60000 and abs(q.a - 15000) < sketches.KLL_ERROR * 60000 and abs(q.b - 45000) < sketches.KLL_ERROR * 60000
    odd = rows.select("event_type", "price").union(spark.sql("SELECT 'view', 1e6D UNION ALL SELECT 'cart', -1e6D"))
    assert sorted(r.price for r in sketches.outside(odd, "price", sketches.fences(values, "event_type"), "event_type").collect()) == [-1e6, 1e6]


@pytest.mark.parametrize("tracked", [10_000, 64])
def test_heavy_hitters_are_exact(spark, tracked):
    many = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot"), (F.col("id") % 7).cast("string"))).otherwise(F.col("id").cast("string")).alias("v")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    want = [tuple(r) for r in many.filter("v IS NOT NULL").groupBy("v").count().orderBy(F.desc("count"), "v").limit(5).collect()]
    assert [tuple(r) for r in sketches.heavy_hitters(many, "v", 5, tracked).collect()] == want
    flat = spark.range(500).select(F.col("id").cast("string").alias("v"))  # no value stands out
    assert [r.v for r in sketches.heavy_hitters(flat, "v", 5, tracked).collect()] == sorted(map(str, range(500)))[:5]
    assert sketches.heavy_hitters(flat.limit(0), "v").count() == 0


def plain(y, a, b, g, m=7):
    level, trend = np.mean(y[:m]), (np.mean(y[m : 2 * m]) - np.mean(y[:m])) / m
    season = [v - np.mean(y[:m]) for v in y[:m]]
    error = 0.0
    for t in range(m, len(y)):
        s, before = season[t % m], level
        error += (y[t] - level - trend - s) ** 2
        level = a * (y[t] - s) + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
        season[t % m] = s + g * (y[t] - level - s)
    return level, trend, season, error


def test_smoothing_is_the_plain_recursion():
    r = np.random.default_rng(3)
    y = 50 + np.arange(60) * 0.7 + 10 * np.sin(np.arange(60) * 2 * np.pi / 7) + r.normal(0, 1, 60)
    level, trend, season, error, grid = learned.smoothed(y)
    for k, (a, b, g) in enumerate(grid.tolist()):
        want = plain(y, a, b, g)
        assert np.allclose([level[k], trend[k], error[k]], [want[0], want[1], want[3]]) and np.allclose(season[k], want[2])
    p, width = learned.holt_winters(y, 14)
    assert np.abs(p - (50 + np.arange(60, 74) * 0.7 + 10 * np.sin(np.arange(60, 74) * 2 * np.pi / 7))).max() < 4 and (np.diff(width) >= 0).all()
    assert learned.holt_winters(np.array([3.0, 5.0]), 3)[0].shape == (3,)


@pytest.fixture(scope="module")
def trended(spark):
    r = np.random.default_rng(5)
    rows = [(f"s{k}", (pd.Timestamp("2019-10-01") + pd.Timedelta(days=i)).date(), float(k * (20 + 2 * i + 8 * (i % 7 == 5) + r.normal(0, 1))), i, 1.0) for k in (1, 10) for i in range(60)]
    return spark.createDataFrame(rows, "series string, date date, revenue double, purchase_events long, avg_purchase_value double")


def test_models_beat_the_mean_on_a_trend(spark, trended):
    naive = {(r.series, r.fold): r.mae for r in series.backtest_detail(trended).collect()}
    found = {(r.series, r.fold): r for r in learned.smooth_backtest(trended).collect()}
    assert found.keys() == naive.keys() and all(found[k].mae < naive[k] / 2 for k in naive)
    assert np.mean([r.covered for r in found.values()]) >= 0.5
    ahead = {r.series: [] for r in found.values()}
    for r in learned.pooled_forecast(trended).orderBy("series", "forecast_date").collect():
        ahead[r.series].append(r.predicted_revenue)
    want = np.array([20 + 2 * i + 8 * (i % 7 == 5) for i in range(60, 67)])
    assert all(len(v) == 7 and np.abs(np.array(v) / k - want).mean() < np.abs(want - want.mean() + 8).mean() for k, v in ((1, ahead["s1"]), (10, ahead["s10"])))
    assert learned.smooth_forecast(trended).filter("low <= predicted_revenue AND predicted_revenue <= high").count() == 14
    assert learned.pooled_forecast(trended.filter("date < '2019-10-06'")).count() == 14


def test_isolation_finds_what_single_scores_miss(spark):
    """Two features that go together but for a few days; each value alone is usual."""
    r = np.random.default_rng(8)
    x = np.concatenate([r.normal(-2, 0.15, 150), r.normal(2, 0.15, 150)])
    rows = [("a", (pd.Timestamp("2019-01-01") + pd.Timedelta(days=i)).date(), float(v), int(100 * v), 1.0) for i, v in enumerate(x)]
    odd = [("a", pd.Timestamp(f"2020-01-0{i}").date(), 0.05 * i, 3 * i, 1.0) for i in (1, 2, 3)]  # between both clusters: near the mean of all
    h = spark.createDataFrame(rows + odd, "series string, date date, revenue double, purchase_events long, avg_purchase_value double")
    top = lambda df, c: {str(r.date)[:4] for r in df.orderBy(F.desc(c)).limit(3).collect()}
    found = learned.isolation_anomalies(h, 0.01)
    assert top(found, "anomaly_score") == {"2020"} and "2020" not in top(series.zscore_anomalies(h, 0.01), "anomaly_score")
    assert found.filter("anomaly_label = 1").count() <= 4
    assert [r.isolation_score for r in learned.isolation_scores(h).orderBy("date").collect()] == [r.isolation_score for r in learned.isolation_scores(h.repartition(5)).orderBy("date").collect()]
    s = learned.isolation_stability(h, 3, 0.01, 50)
    assert s.count() == 303 and s.filter("date >= '2020-01-01'").agg(F.min("flag_rate")).first()[0] > 0.5
    assert learned.isolation_scores(h.limit(0)).count() == 0


def test_tree_depths():
    nodes = np.array(learned.grow(np.array([[0.0], [1.0], [10.0]]), 1))
    d = learned.depths(np.array([[0.0], [10.0], [11.0]]), nodes)
    assert d[1] == d[2] <= d[0]


def test_pca_scores_are_what_the_components_leave(spark, trended):
    x = trended.toPandas()[list(series.FEATURES)].to_numpy(float)
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    two = vectors[:, np.argsort(values)[::-1][:2]]
    want = np.sort(((z - z @ two @ two.T) ** 2).sum(axis=1))
    got = np.sort([r.anomaly_score for r in series.pca_anomalies(trended).collect()])
    assert np.allclose(want, got, atol=1e-8)


def test_marts_reach_a_database_and_reports_a_file(spark, tmp_path):
    lines = ["event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session", "2019-10-01 09:00:00 UTC,purchase,1,1,a.b,x,5,1,s1"]
    (tmp_path / "e.csv").write_text("\n".join(lines))
    base, url = str(tmp_path / "b"), f"jdbc:derby:{tmp_path}/db;create=true"
    properties = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark._jvm.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    spark.createDataFrame([(1,)], "x int").write.jdbc(url, "one_row", "overwrite", properties)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().execute("CREATE SCHEMA staging")
    connection.close()
    for run in ("r1", "r2"):  # the second overwrites
        report = warehouse.run_warehouse(spark, str(tmp_path / "e.csv"), base, run, jdbc=(url, properties))
    rows = spark.read.jdbc(url, "staging.daily_revenue", properties=properties).collect()
    assert len(rows) == 1 and rows[0].revenue == 5.0 and str(rows[0].event_date) == "2019-10-01"
    assert warehouse.write_report(spark, report, base) == warehouse.write_report(spark, report, base)
    assert json.loads((tmp_path / "b" / "audit" / "reports" / "r2.json").read_text())["gold_rows"] == 1


def test_price_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"snapshot_time": "2019-10-01 10:00:00", "site": " Shop ", "product_id": "1", "price": 5.0}, {"snapshot_time": "2019-10-01 10:00:00", "site": "shop", "product_id": None, "price": 5.0}]
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, rows)))
    raw = spark.readStream.schema("snapshot_time timestamp, site string, product_id string, price double").json(str(tmp_path / "in"))
    speed.start_prices(raw, str(tmp_path / "good"), str(tmp_path / "dead"), str(tmp_path / "cp")).awaitTermination()
    assert [(r.site, r.product_id) for r in spark.read.parquet(str(tmp_path / "good")).collect()] == [("shop", "1")]
    assert [r.error for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == ["missing_product_id"]


def test_store_and_stream_settings(spark):
    o = files.s3a_options("http://store:9000", "k", "s")
    assert o["spark.hadoop.fs.s3a.path.style.access"] == "true" and o["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false" and o["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert sinks._silver_path("s3a://lake", "2019-10-01/r/0-1") == "s3a://lake/silver/events/event_date=2019-10-01/run_id=r/shard=0-1"
