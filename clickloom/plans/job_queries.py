"""Registered queries through the readers, sinks, the batch job and the streams, over the given tables.

Raw files, messages and zones are derived from the events table by Spark and written to the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import learned, prices, series, sketches
from ..sources import files, sinks
from ..sources.commits import Folder
from ..sources.tables import INGESTED, canonical, metric_events, normalized, raw_events, raw_prices
from ..streaming import gate, sessions, speed
from . import warehouse
from .catalog import ANOMALY, CANON, EV, FOLDS, METRICS, NAIVE, ORACLES, PRICE, SERIES, _canon, _series, query, rounded, shared_place

_BASES: dict[tuple, str] = {}


def _csv(df: DataFrame, path: str) -> None:
    df.withColumn("price", F.col("price").cast("string")).write.option("header", True).option("escape", '"').csv(path)


def _fingerprint(spark: SparkSession, d: str) -> tuple[str, ...]:
    """Path, length and time of change of the files that the job's input is made of."""
    folders = [Folder(spark, f"{d}/{t}.parquet") for t in ("events", "part")]
    return tuple(f"{x.getPath()} {x.getLen()} {x.getModificationTime()}" for f in folders for x in f.fs.listStatus(f.at))


def _job(spark: SparkSession, d: str, runs: int = 1) -> str:
    """The base URI after the batch job took in the events as CSV: at once, or those of the first half of time and then the rest.

    Queries over the same files share one run of the job; changed files make another.
    """
    key = spark.sparkContext.applicationId, runs, *_fingerprint(spark, d)
    if key not in _BASES:
        base, raw = shared_place(spark), raw_events(spark, d)
        if runs == 1:
            parts = [raw]
        else:
            middle = raw.select(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
            at = F.unix_timestamp(F.substring("event_time", 1, 19))
            half = (F.unix_timestamp(F.lit(middle.a[:19])) + F.unix_timestamp(F.lit(middle.b[:19]))) / 2
            parts = [raw.filter(at < half), raw.filter(~(at < half) | at.isNull())]
        for k, part in enumerate(parts):
            _csv(part, f"{base}/landing/{k}.csv")
            warehouse.run_warehouse(spark, f"{base}/landing/{k}.csv", base, f"run-{k}", incremental=k > 0)
        _BASES[key] = base
    return _BASES[key]


def _mart(spark: SparkSession, d: str, name: str, runs: int = 1) -> DataFrame:
    return rounded(sinks.read_mart(spark, _job(spark, d, runs), name))


@query(ORACLES["canonical_events"])
def csv_events(spark: SparkSession, d: str) -> DataFrame:
    """The events written as CSV and read by the raw reader."""
    place = shared_place(spark) + "/events.csv"
    _csv(raw_events(spark, d), place)
    return _canon(ev.normalize(files.read_raw(spark, place), "run-1", INGESTED).filter(ev.rejection_reason().isNull()))


@query(ORACLES["canonical_events"])
def json_events(spark: SparkSession, d: str) -> DataFrame:
    """The events written as JSON lines and read by the raw reader."""
    place = shared_place(spark) + "/events-json"
    raw_events(spark, d).write.json(place)
    return _canon(ev.normalize(files.read_raw(spark, place), "run-1", INGESTED).filter(ev.rejection_reason().isNull()))


@query(f"{EV} SELECT count(*) AS events, count(*) AS with_file FROM norm")
def source_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a raw file tells the file that it came from."""
    place = shared_place(spark) + "/events.csv"
    _csv(raw_events(spark, d), place)
    rows = ev.normalize(files.read_raw(spark, place), "run-1", INGESTED)
    return rows.agg(F.count("*").alias("events"), F.count_if(F.col("source_file").endswith(".csv") & F.col("source_file").contains("events.csv/part-")).alias("with_file"))


@query(f"{EV} SELECT 'SUCCESS' AS status, (SELECT count(*) FROM norm)::BIGINT AS bronze_rows, (SELECT count(*) FROM ev)::BIGINT AS silver_rows, (SELECT count(*) FROM norm WHERE rejection_reason IS NOT NULL)::BIGINT AS rejected_rows, (SELECT count(*) FROM ev)::BIGINT AS gold_rows")
def job_run_audit(spark: SparkSession, d: str) -> DataFrame:
    return sinks.last_runs(spark, _job(spark, d)).select("status", "bronze_rows", "silver_rows", "rejected_rows", "gold_rows")


@query(ORACLES["quality_results"])
def job_quality_audit(spark: SparkSession, d: str) -> DataFrame:
    return sinks.last_checks(spark, _job(spark, d)).select("check_name", "status", "observed_value", "expectation")


@query(f"{EV} SELECT count(*) AS events FROM norm")
def bronze_zone(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(files.zone_uri(_job(spark, d), "bronze", "events")).agg(F.count("*").alias("events"))


@query(f"{EV} SELECT {CANON} FROM ev")
def silver_zone(spark: SparkSession, d: str) -> DataFrame:
    return _canon(sinks.read_silver(spark, _job(spark, d)))


@query(ORACLES["rejected_by_reason"])
def quarantine_zone(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(files.zone_uri(_job(spark, d), "silver", "quarantine"))
    return rows.groupBy("rejection_reason").agg(F.count("*").alias("events"))


@query(f"{EV} SELECT strftime(event_date, '%Y%m%d')::INT AS date_key, count(*) AS events, round(sum(price)::DOUBLE, 4) AS price FROM ev GROUP BY 1")
def gold_fact(spark: SparkSession, d: str) -> DataFrame:
    rows = sinks.read_gold(spark, _job(spark, d), "fact_behavior_event")
    return rounded(rows.groupBy(F.col("date_key").cast("int").alias("date_key")).agg(F.count("*").alias("events"), F.sum("price").cast("double").alias("price")), 4)


USERS = f"{EV} SELECT source_user_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_seen_at FROM ev GROUP BY 1"


@query(f"{EV} SELECT 'dim_user' AS dimension, count(DISTINCT source_user_id) AS n FROM ev UNION ALL SELECT 'dim_product', count(DISTINCT source_product_id) FROM ev UNION ALL SELECT 'dim_category', count(DISTINCT category_code) FROM ev UNION ALL SELECT 'dim_date', count(DISTINCT event_date) FROM ev")
def gold_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each dimension, as two runs left its parts."""
    base = _job(spark, d, 2)
    each = [sinks.read_dimension(spark, base, n).agg(F.lit(n).alias("dimension"), F.count("*").alias("n")) for n in ("dim_user", "dim_product", "dim_category", "dim_date")]
    return each[0].union(each[1]).union(each[2]).union(each[3])


@query(USERS)
def gold_users(spark: SparkSession, d: str) -> DataFrame:
    """Users merged from the parts of days that two runs wrote."""
    return rounded(sinks.read_dimension(spark, _job(spark, d, 2), "dim_user").select("source_user_id", "first_seen_at", "last_seen_at"))


@query(f"{EV} SELECT source_product_id, max_by(brand, (event_time, event_key)) AS brand, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_seen_at FROM ev GROUP BY 1")
def gold_products(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sinks.read_dimension(spark, _job(spark, d, 2), "dim_product").select("source_product_id", "brand", "first_seen_at"))


@query(f"{EV} SELECT event_key, strftime(event_date, '%Y%m%d')::INT AS date_key, session_id, price::DOUBLE AS price FROM ev")
def incremental_fact(spark: SparkSession, d: str) -> DataFrame:
    """The fact table after two runs, the second of which wrote only the days that it touched."""
    return rounded(sinks.read_gold(spark, _job(spark, d, 2), "fact_behavior_event").select("event_key", F.col("date_key").cast("int").alias("date_key"), "session_id", F.col("price").cast("double").alias("price")))


@query(ORACLES["product_daily"])
def incremental_products(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "product_daily", 2)


@query(ORACLES["category_daily"])
def incremental_categories(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "category_daily", 2)


@query(ORACLES["funnel_daily"])
def published_funnel(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "funnel_daily")


@query(ORACLES["session_daily"])
def published_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "session_daily")


@query(ORACLES["funnel_daily"])
def incremental_funnel(spark: SparkSession, d: str) -> DataFrame:
    """The funnel after two runs, the second of which rewrote only the days that it touched."""
    return _mart(spark, d, "funnel_daily", 2)


@query(ORACLES["session_daily"])
def incremental_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "session_daily", 2)


@query(ORACLES["daily_revenue"])
def incremental_revenue(spark: SparkSession, d: str) -> DataFrame:
    r = sinks.read_mart(spark, _job(spark, d, 2), "daily_revenue")
    return rounded(r.withColumn("revenue", F.round("revenue", 2)))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """Events as wire messages; those of type `error` are cut short, those of type `signup` lack their type."""
    whole = F.to_json(F.struct("event_time", "event_type", "product_id", "category_code", "brand", "price", "user_id", "user_session"))
    typeless = F.to_json(F.struct("event_time", "product_id", "user_id"))
    cut = F.when(F.col("event_type") == "error", F.expr("substr(whole, 1, length(whole) - 1)")).when(F.col("event_type") == "signup", F.col("typeless")).otherwise(F.col("whole"))
    return raw_events(spark, d).select("event_type", whole.alias("whole"), typeless.alias("typeless")).select(cut.alias("value"))


@query(f"{EV} SELECT CASE event_type WHEN 'error' THEN 'not_json' WHEN 'signup' THEN 'no_event_type' ELSE rejection_reason END AS reason, count(*) AS messages FROM norm WHERE event_type IN ('error', 'signup') OR rejection_reason IS NOT NULL GROUP BY 1")
def message_rejections(spark: SparkSession, d: str) -> DataFrame:
    """Reasons of the stream's dead letters, unreadable messages among them."""
    rows = speed.contract_events(_messages(spark, d), "run-1", INGESTED).filter("rejection_reason IS NOT NULL")
    return ev.dead_letters(rows, "events").groupBy(F.col("error").alias("reason")).agg(F.count("*").alias("messages"))


@query(f"{EV} SELECT event_type, count(*) AS events FROM ev GROUP BY 1")
def raw_event_stream(spark: SparkSession, d: str) -> DataFrame:
    """Messages read as a stream: each valid event once, the rest to dead letters."""
    place = shared_place(spark)
    _messages(spark, d).write.text(f"{place}/in")
    speed.start_raw(files.read_stream(spark, "text", f"{place}/in"), f"{place}/good", f"{place}/dead", f"{place}/cp", "run-1", INGESTED, every=None).awaitTermination()
    return spark.read.parquet(f"{place}/good").groupBy("event_type").agg(F.count("*").alias("events"))


@query(f"{EV} SELECT CASE event_type WHEN 'cart' THEN 'add_to_cart' WHEN 'view' THEN 'page_view' ELSE event_type END AS event_type, count(*) AS documents FROM norm WHERE event_type NOT IN ('error', 'signup') GROUP BY 1")
def raw_index_stream(spark: SparkSession, d: str) -> DataFrame:
    place = shared_place(spark)
    _messages(spark, d).write.text(f"{place}/in")
    speed.start_index(files.read_stream(spark, "text", f"{place}/in"), f"{place}/index", f"{place}/cp", every=None).awaitTermination()
    return spark.read.parquet(f"{place}/index").groupBy(F.get_json_object("document", "$.event_type").alias("event_type")).agg(F.count("id").alias("documents"))


@query(ORACLES["wire_events"])
def published_messages(spark: SparkSession, d: str) -> DataFrame:
    """Events published to a sink of messages and read from there."""
    place = shared_place(spark)
    speed.publish(canonical(spark, d), place)
    return spark.read.json(place).select("key", *(F.get_json_object("value", f"$.{c}").alias(c) for c in ("event_time", "event_type", "product_id")))


def _metric_stream(spark: SparkSession, d: str) -> str:
    place = shared_place(spark)
    source = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    stream = metric_events(ev.normalize(raw_events(spark, d, source), "run-1", INGESTED))
    speed.start_metrics(stream, f"{place}/metrics", f"{place}/checkpoint", every=None, served=f"{place}/served").awaitTermination()
    return place


@query(METRICS + " SELECT event_type, strftime(max(window_start), '%Y-%m-%d %H:%M:%S') AS window_start, max_by(event_count, window_start) AS event_count, round(max_by(revenue, window_start), 4) AS revenue FROM m GROUP BY 1 HAVING max(m.window_start) + INTERVAL 1 HOUR >= (SELECT max(window_start) FROM m)")
def served_kpi(spark: SparkSession, d: str) -> DataFrame:
    """The KPI table that the stream keeps."""
    rows = speed.read_served(spark, f"{_metric_stream(spark, d)}/served", "kpi")
    return rounded(rows.select("event_type", "window_start", "event_count", "revenue"), 4)


@query(ORACLES["revenue_series"])
def served_revenue_series(spark: SparkSession, d: str) -> DataFrame:
    """The series table that the stream keeps; its length is the feature."""
    return rounded(speed.read_served(spark, f"{_metric_stream(spark, d)}/served", "revenue_series"), 4)


@query(ORACLES["windowed_metrics_stream"])
def compacted_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The stream's metrics after its batches' folders were merged."""
    place = _metric_stream(spark, d) + "/metrics"
    speed.compact_metrics(spark, place, max(speed._versions(spark, place)) + 1)  # the stream has ended: no batch comes again
    return rounded(speed.read_metrics(spark, place).select("window_start", "event_type", "event_count", "amount"), 4)


@query(NAIVE + " SELECT series, forecast_date, model, round(predicted_revenue, 6) AS predicted_revenue FROM naive ORDER BY naive.forecast_date DESC, model, series LIMIT 500")
def forecast_comparison(spark: SparkSession, d: str) -> DataFrame:
    """A report of 500 rows at most: its limit is the feature."""
    return rounded(series.forecast_comparison(series.naive_forecast(_series(spark, d))))


@query(ANOMALY + " SELECT series, date, round(anomaly_score, 6) AS anomaly_score FROM anomaly WHERE anomaly_label = 1 ORDER BY anomaly.anomaly_score DESC, series, date LIMIT 200")
def anomaly_report(spark: SparkSession, d: str) -> DataFrame:
    """A report of 200 rows at most: its limit is the feature."""
    return rounded(series.anomaly_report(series.zscore_anomalies(_series(spark, d))).select("series", "date", "anomaly_score"))


@query(ANOMALY + " SELECT series, date, round(revenue, 6) AS revenue, round(anomaly_score, 6) AS anomaly_score FROM anomaly WHERE anomaly_label = 1 ORDER BY date, series")
def anomaly_days(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.anomaly_days(series.zscore_anomalies(_series(spark, d))).select("series", "date", "revenue", "anomaly_score"))


@query(SERIES + " SELECT series, date, round(revenue, 6) AS revenue FROM hist ORDER BY series, date")
def sorted_series(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.sorted_series(_series(spark, d)))


@query(FOLDS + " SELECT series, fold::INT AS fold, test_start, test_end, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 6) AS mape FROM detail")
def model_backtest_naive(spark: SparkSession, d: str) -> DataFrame:
    """The pluggable backtest, held against the windowed one on the model that SQL can state."""
    rows = series.model_backtest(_series(spark, d), {"naive7": series.FORECASTERS["naive7"]})
    return rounded(rows.select("series", "fold", "test_start", "test_end", "model", "mae", "rmse", "mape"))


@query()
def model_backtest(spark: SparkSession, d: str) -> DataFrame:
    """Mean errors of every model over the folds of every series."""
    return rounded(series.backtest(series.model_backtest(_series(spark, d))))


@query(PRICE + " SELECT site, substr(day, 1, 4) || '-01-01' AS run_date, count(*) AS snapshots FROM marked WHERE rejection_reason IS NULL GROUP BY 1, 2")
def landed_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Price snapshots landed by day and site, those of a year dated to its first day."""
    place, rows = shared_place(spark), raw_prices(spark, d).withColumn("snapshot_time", F.date_trunc("year", "snapshot_time"))
    sinks.write_snapshots(prices.split_prices(prices.normalize_prices(rows))[0], place)
    rows = spark.read.parquet(files.zone_uri(place, "bronze", "prices"))
    return rows.groupBy("site", F.date_format("run_date", "yyyy-MM-dd").alias("run_date")).agg(F.count("*").alias("snapshots"))


@query(NAIVE + " SELECT series, forecast_date, model, round(predicted_revenue, 6) AS predicted_revenue FROM naive")
def replaced_table(spark: SparkSession, d: str) -> DataFrame:
    """A result table that a second write replaces."""
    place, f = shared_place(spark), series.naive_forecast(_series(spark, d))
    for _ in range(2):
        sinks.replace_table(f, place, ["series", "forecast_date", "model", "predicted_revenue"])
    return rounded(spark.read.parquet(place))


@query(f"{EV} SELECT event_type, count(*) AS events FROM norm GROUP BY 1")
def event_view(spark: SparkSession, d: str) -> DataFrame:
    """A named view, read by SQL."""
    sinks.create_views(spark, {"clickloom_events": normalized(spark, d)})
    return spark.sql("SELECT event_type, count(*) AS events FROM clickloom_events GROUP BY event_type")



@query(ORACLES["session_daily"])
def streamed_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions as the stream's state has them, from all events as messages."""
    place = shared_place(spark)
    whole = F.to_json(F.struct("event_time", "event_type", "product_id", "category_code", "brand", "price", "user_id", "user_session"))
    raw_events(spark, d).select(whole.alias("value")).write.text(f"{place}/in")
    sessions.start_sessions(files.read_stream(spark, "text", f"{place}/in"), f"{place}/out", f"{place}/cp", "run-1", INGESTED, every=None).awaitTermination()
    return rounded(sessions.read_sessions(spark, f"{place}/out"))


SPANS = EV + """, span AS (
  SELECT 'day' AS span, strftime(date_trunc('day', event_time), '%Y-%m-%d') AS start, source_user_id FROM norm UNION ALL SELECT 'week', strftime(date_trunc('week', event_time), '%Y-%m-%d'), source_user_id FROM norm
  UNION ALL SELECT 'all', '', source_user_id FROM norm
)"""


@query(SPANS + " SELECT span, start, count(DISTINCT source_user_id) AS users, true AS within FROM span GROUP BY 1, 2")
def sketched_users(spark: SparkSession, d: str) -> DataFrame:
    """Users by day, by week and in all, counted exactly, and whether daily sketches united over the span come within their error."""
    rows = metric_events(normalized(spark, d))
    kept = sketches.user_sketches(rows)
    out = None
    for span, start in (("day", lambda c: F.date_format(c, "yyyy-MM-dd")), ("week", lambda c: F.date_format(F.date_trunc("week", c), "yyyy-MM-dd")), ("all", lambda c: F.lit(""))):
        guess = sketches.users_over(kept, start("bucket").alias("start"))
        exact = rows.groupBy(start("event_time").alias("start")).agg(F.count_distinct("user_id").alias("exact"))
        one = exact.join(guess, "start").select(F.lit(span).alias("span"), "start", F.col("exact").alias("users"), (F.abs(F.col("users") - F.col("exact")) <= sketches.HLL_ERROR * F.col("exact") + 1).alias("within"))
        out = one if out is None else out.union(one)
    return out


@query(EV + " SELECT event_type, count(*) AS n, 3 AS quantiles_within FROM norm WHERE price IS NOT NULL GROUP BY 1")
def sketched_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """How many of the quartiles of price, from sketches of each day merged, have a rank within the sketches' error."""
    rows = normalized(spark, d).select("event_type", "event_date", F.col("price").cast("double").alias("price"))
    found = sketches.quantiles_over(sketches.value_sketches(rows, "price", "event_type", "event_date"), {"q1": 0.25, "q2": 0.5, "q3": 0.75}, "event_type")
    ranks = rows.filter("price IS NOT NULL").join(found, "event_type").groupBy("event_type", "n").agg(*(F.avg((F.col("price") <= F.col(q)).cast("double")).alias(q) for q in ("q1", "q2", "q3")))
    good = [(F.abs(F.col(q) - p) <= sketches.KLL_ERROR).cast("int") for q, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))]
    return ranks.select("event_type", "n", (good[0] + good[1] + good[2]).alias("quantiles_within"))


@query(EV + """, q AS (SELECT event_type, quantile_disc(price::DOUBLE, 0.25) AS q1, quantile_disc(price::DOUBLE, 0.75) AS q3 FROM norm WHERE price IS NOT NULL GROUP BY 1)
  SELECT event_type, count(*) AS above FROM norm JOIN q USING (event_type) WHERE price > q1 + 2 * (q3 - q1) GROUP BY 1""")
def price_outliers(spark: SparkSession, d: str) -> DataFrame:
    """Prices above the first quartile by more than twice the distance of the quartiles; the quartiles are exact ones."""
    rows = normalized(spark, d).select("event_type", F.col("price").cast("double").alias("price")).filter("price IS NOT NULL")
    q = rows.groupBy("event_type").agg(F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY price)").alias("q1"), F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY price)").alias("q3"))
    bounds = q.select("event_type", F.lit(float("-inf")).alias("low"), (F.col("q1") + 2 * (F.col("q3") - F.col("q1"))).alias("high"))
    return sketches.outside(rows, "price", bounds, "event_type").groupBy("event_type").agg(F.count("*").alias("above"))


def _hitters(column: str) -> str:
    return f"{EV} SELECT {column}, count(*) AS events FROM norm WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"


@query(_hitters("source_product_id"))
def heavy_products(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent products, named by a bounded summary and counted exactly; ten rows are the feature."""
    return sketches.heavy_hitters(normalized(spark, d), "source_product_id")


@query(_hitters("source_user_id"))
def heavy_users(spark: SparkSession, d: str) -> DataFrame:
    """The ten most active users; ten rows are the feature."""
    return sketches.heavy_hitters(normalized(spark, d), "source_user_id", tracked=1000)


@query()
def smooth_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Seven days of each series by smoothed level, trend and season, with intervals."""
    return rounded(learned.smooth_forecast(_series(spark, d)))


@query()
def smooth_backtest(spark: SparkSession, d: str) -> DataFrame:
    return rounded(learned.smooth_backtest(_series(spark, d)))


@query()
def pooled_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Seven days of each series by one regression over all of them."""
    return rounded(learned.pooled_forecast(_series(spark, d)))


@query()
def isolation_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Days that isolation trees set apart soonest."""
    return rounded(learned.isolation_anomalies(_series(spark, d)))


@query(EV + """, m AS (SELECT *, CASE WHEN event_type = 'error' THEN 'not_json' WHEN event_type = 'signup' THEN 'no_event_type' ELSE rejection_reason END AS reason FROM norm)
  SELECT 'batch_rejected_share' AS check_name, 'PASSED' AS status, count(*) FILTER (reason IS NOT NULL) AS observed_value FROM m UNION ALL SELECT 'batch_required_fields_complete', 'PASSED', 0 UNION ALL SELECT 'batch_event_key_unique', 'PASSED', 0""")
def gated_stream(spark: SparkSession, d: str) -> DataFrame:
    """What the gate saw of the events' messages, of which each is unlike the others, in all micro-batches."""
    place = shared_place(spark)
    _messages(spark, d).select(F.expr("CASE WHEN get_json_object(value, '$.event_type') IS NULL THEN concat(value, ' ', monotonically_increasing_id()) ELSE value END").alias("value")).write.text(f"{place}/in")
    gate.start_gated(files.read_stream(spark, "text", f"{place}/in"), f"{place}/good", f"{place}/dead", f"{place}/cp", place, "run-1", INGESTED, 1.0, every=None).awaitTermination()
    rows = sinks.latest_audit(spark, place, "data_quality_result", "run_id", "check_name")
    return rows.groupBy("check_name", "status").agg(F.sum("observed_value").alias("observed_value"))


def _variant(spark: SparkSession, d: str) -> DataFrame:
    """The events with the raw contract's other columns: seconds since 1970, lists of products, an amount and a plain category."""
    at = F.unix_timestamp(F.substring("event_time", 1, 19)).cast("string")
    return raw_events(spark, d).select("event_type", at.alias("timestamp"), F.array("product_id", F.lit("0")).alias("product_ids"), F.col("price").alias("total_amount"), "user_id", F.col("user_session").alias("session_id"), F.col("category_code").alias("category"), "brand")


VARIANT = "event_key, event_type, source_user_id, source_product_id, session_id, category_code, brand"


@query(f"{EV} SELECT {VARIANT}, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, price::DOUBLE AS price FROM norm WHERE rejection_reason IS NULL")
def variant_events(spark: SparkSession, d: str) -> DataFrame:
    """Epoch times, product lists, amounts and categories come to the same events, to the second."""
    rows = ev.normalize(_variant(spark, d), "run-1", INGESTED).filter(ev.rejection_reason().isNull())
    return rounded(rows.select(*VARIANT.split(", "), "event_time", F.col("price").cast("double").alias("price")))


@query(f"{EV} SELECT {VARIANT}, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, price::DOUBLE AS price FROM norm WHERE rejection_reason IS NULL")
def strict_events(spark: SparkSession, d: str) -> DataFrame:
    """The row contract: other names for user and time, padded strings, blank categories."""
    pad = lambda c: F.concat(F.lit(" "), c, F.lit("  "))
    raw = raw_events(spark, d).select("event_type", F.col("event_time").alias("order_date"), pad("product_id").alias("product_id"), "price", pad("user_id").alias("customer_id"), "user_session", F.coalesce("category_code", F.lit("  ")).alias("category_code"), pad("brand").alias("brand"))
    rows = ev.normalize(raw, "run-1", INGESTED, strict_contract=True).filter(ev.rejection_reason().isNull())
    return rounded(rows.select(*VARIANT.split(", "), "event_time", F.col("price").cast("double").alias("price")))
