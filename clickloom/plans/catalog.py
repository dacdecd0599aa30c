"""All registered queries over the given tables, and the DuckDB SQL that states the same rows.

Times are given as text and doubles rounded, so that both sides print alike.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import MART_COLUMNS
from ..operators import events as ev
from ..operators import marts, prices, quality, series, serving, star
from ..sources.tables import INGESTED, canonical, metric_events, normalized, raw_events, raw_prices

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EV = """
WITH raw AS (
  SELECT CASE e.event_type WHEN 'click' THEN 'cart' ELSE e.event_type END AS event_type, e.user_id::VARCHAR AS source_user_id, json_extract_string(e.props, '$.k') AS source_product_id,
    coalesce(lower(p.p_type || '.' || split_part(p.p_name, ' ', 2)), 'unknown') AS category_code, p.p_brand AS brand, e.user_id::VARCHAR || '-' || strftime(e.ts, '%Y-%m-%d') AS session_id,
    e.ts AS event_time, e.ts::DATE AS event_date, e.value::DECIMAL(18,4) AS price
  FROM events e LEFT JOIN part p ON p.p_partkey = try_cast(json_extract_string(e.props, '$.k') AS BIGINT)
), norm AS (
  SELECT *, sha256(concat_ws('||', coalesce(event_type, ''), coalesce(source_user_id, ''), coalesce(source_product_id, ''), coalesce(session_id, ''), coalesce(strftime(event_time, '%Y-%m-%d %H:%M:%S'), ''))) AS event_key,
    CASE WHEN event_type NOT IN ('view', 'cart', 'purchase') THEN 'unsupported_event_type' WHEN event_time IS NULL THEN 'missing_event_time' WHEN trim(coalesce(source_user_id, '')) = '' THEN 'missing_user_id'
      WHEN trim(coalesce(source_product_id, '')) = '' THEN 'missing_product_id' WHEN price < 0 THEN 'negative_price' END AS rejection_reason
  FROM raw
), ev AS (
  SELECT * FROM norm WHERE rejection_reason IS NULL QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY event_time, price) = 1
)"""
FUNNEL = EV + """, users AS (
  SELECT event_date, count(DISTINCT source_user_id) FILTER (event_type = 'view') AS viewers, count(DISTINCT source_user_id) FILTER (event_type = 'cart') AS cart_users, count(DISTINCT source_user_id) FILTER (event_type = 'purchase') AS buyers FROM ev GROUP BY 1
)"""
TALLY = "count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart') AS cart_adds, count(*) FILTER (event_type = 'purchase') AS purchase_events, coalesce(sum(price) FILTER (event_type = 'purchase'), 0)::DOUBLE AS revenue"
PRODUCT = EV + f""", product AS (
  SELECT event_date, source_product_id AS product_id, min_by(brand, (event_time, event_key)) FILTER (brand IS NOT NULL) AS brand, min_by(category_code, (event_time, event_key)) AS category_code, {TALLY} FROM ev GROUP BY 1, 2
)"""
DAILY = EV + """, daily AS (
  SELECT event_date, coalesce(sum(price) FILTER (event_type = 'purchase'), 0)::DOUBLE AS revenue, count(*) FILTER (event_type = 'purchase') AS purchase_events, count(DISTINCT source_user_id) FILTER (event_type = 'purchase') AS buyers FROM ev GROUP BY 1
), feat AS (SELECT event_date, revenue, purchase_events, CASE WHEN purchase_events > 0 THEN revenue / purchase_events ELSE 0 END AS avg_purchase_value FROM daily)"""
SESSION = EV + """, session AS (
  SELECT session_id, min_by(source_user_id, (event_time, event_key)) AS user_id, min(event_time) AS session_start, max(event_time) AS session_end, count(*) AS event_count, count(DISTINCT source_product_id) AS product_count,
    count(*) FILTER (event_type = 'view') AS view_count, count(*) FILTER (event_type = 'cart') AS cart_count, count(*) FILTER (event_type = 'purchase') AS purchase_count
  FROM ev WHERE trim(session_id) <> '' GROUP BY 1
), outcome AS (
  SELECT *, session_start::DATE AS event_date, (epoch(date_trunc('second', session_end)) - epoch(date_trunc('second', session_start)))::BIGINT AS duration_seconds,
    CASE WHEN purchase_count > 0 THEN 'converted' WHEN cart_count > 0 THEN 'abandoned_cart' ELSE 'browsing' END AS session_outcome FROM session
)"""
METRICS = EV + """, metric AS (
  SELECT date_trunc('minute', event_time) AS window_start, event_type, count(*) AS event_count, count(DISTINCT source_user_id) AS unique_users, sum(coalesce(price::DOUBLE, 0)) AS amount FROM norm GROUP BY 1, 2
), m AS (SELECT *, CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END AS revenue FROM metric)"""
SERIES = EV + """, each AS (
  SELECT unnest([ 'all', split_part(category_code, '.', 1) ]) AS series, event_date AS date, event_type, price FROM ev
), part_days AS (
  SELECT series, date, coalesce(sum(price) FILTER (event_type = 'purchase'), 0)::DOUBLE AS revenue, count(*) FILTER (event_type = 'purchase') AS purchase_events FROM each GROUP BY 1, 2
), span AS (
  SELECT series, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM part_days GROUP BY 1
), hist AS (
  SELECT series, date, coalesce(revenue, 0) AS revenue, coalesce(purchase_events, 0) AS purchase_events, CASE WHEN purchase_events > 0 THEN revenue / purchase_events ELSE 0 END AS avg_purchase_value FROM span LEFT JOIN part_days USING (series, date)
)"""
NAIVE = SERIES + """, level AS (
  SELECT series, greatest(avg(revenue), 0) AS predicted_revenue, max(date) AS fin FROM (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 7) GROUP BY 1
), naive AS (SELECT series, fin + s::INT AS forecast_date, 'naive7' AS model, predicted_revenue FROM level, range(1, 8) t(s))"""
FOLDS = SERIES + """, num AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM hist
), hold AS (SELECT *, least(7, greatest(2, n // 5)) AS h FROM num WHERE n >= 5), fit AS (SELECT *, least(3, (n - greatest(5, h)) // h) AS k FROM hold WHERE n - greatest(5, h) >= h
), fold AS (SELECT *, unnest(range(0, k)) AS fold FROM fit), cut AS (SELECT *, n - (k - fold) * h AS c FROM fold
), pred AS (SELECT *, greatest(avg(revenue) FILTER (i < c) OVER (PARTITION BY series, fold), 0) AS p FROM cut WHERE i >= c - 7 AND i < c + h
), detail AS (
  SELECT series, fold, min(date) AS test_start, max(date) AS test_end, 'naive7' AS model, avg(abs(revenue - p)) AS mae, avg((revenue - p) ** 2) AS mse, sqrt(avg((revenue - p) ** 2)) AS rmse, avg(abs(revenue - p) / greatest(revenue, 1)) * 100 AS mape FROM pred WHERE i >= c GROUP BY 1, 2
)"""
ANOMALY = SERIES + """, z AS (
  SELECT *, coalesce((revenue - avg(revenue) OVER s) / nullif(stddev_pop(revenue) OVER s, 0), 0) AS z1, coalesce((purchase_events - avg(purchase_events) OVER s) / nullif(stddev_pop(purchase_events) OVER s, 0), 0) AS z2,
    coalesce((avg_purchase_value - avg(avg_purchase_value) OVER s) / nullif(stddev_pop(avg_purchase_value) OVER s, 0), 0) AS z3 FROM hist WINDOW s AS (PARTITION BY series)
), score AS (SELECT *, z1 * z1 + z2 * z2 + z3 * z3 AS anomaly_score FROM z
), anomaly AS (SELECT *, (anomaly_score > quantile_cont(anomaly_score, 0.95) OVER (PARTITION BY series))::INT AS anomaly_label FROM score)"""
PRICE = """WITH price AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, lower(trim(coalesce(s_name, ''))) AS site, coalesce(p_partkey::VARCHAR, '') AS product_id, trim(coalesce(p_name, '')) AS product_name, trim(coalesce(p_brand, '')) AS brand,
    CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END AS price, p_retailprice AS list_price, 'VND' AS currency, coalesce(l_linestatus = 'O', true) AS in_stock
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
), marked AS (
  SELECT *, CASE WHEN site = '' THEN 'missing_site' WHEN product_id = '' THEN 'missing_product_id' WHEN price IS NULL THEN 'missing_price' WHEN price < 0 THEN 'negative_price' WHEN list_price < 0 THEN 'negative_list_price' END AS rejection_reason FROM price
)"""


def query(sql: str | None = None):  # noqa: ANN201
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def shared_place(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; a temporary one only where that is unset and all runs on one machine."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given is None and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{given or tempfile.mkdtemp(prefix='spark-')}/{uuid.uuid4().hex}"


def text_time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t in ("double", "float") else text_time(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))


def _series(spark: SparkSession, d: str) -> DataFrame:
    """The daily series, a few rows a day, written once and read from there: models pass over them many times, over the events once."""
    place = shared_place(spark)
    series.daily_series(canonical(spark, d)).write.parquet(place)
    return spark.read.parquet(place)


def _revenue(spark: SparkSession, d: str) -> DataFrame:
    return marts.daily_revenue(canonical(spark, d))


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return serving.with_revenue(serving.windowed_metrics(metric_events(normalized(spark, d)), exact=True))


CANON = "event_type, source_user_id, source_product_id, category_code, brand, session_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, price::DOUBLE AS price, event_date, event_key"


def _canon(df: DataFrame) -> DataFrame:
    return df.select("event_type", "source_user_id", "source_product_id", "category_code", "brand", "session_id", text_time("event_time"), F.col("price").cast("double").alias("price"), "event_date", "event_key")


@query(f"{EV} SELECT {CANON} FROM norm WHERE rejection_reason IS NULL")
def canonical_events(spark: SparkSession, d: str) -> DataFrame:
    return _canon(normalized(spark, d).filter(ev.rejection_reason().isNull()))


@query(f"{EV} SELECT rejection_reason, count(*) AS events FROM norm WHERE rejection_reason IS NOT NULL GROUP BY 1")
def rejected_by_reason(spark: SparkSession, d: str) -> DataFrame:
    return ev.split(normalized(spark, d))[1].groupBy("rejection_reason").agg(F.count("*").alias("events"))


@query(f"{EV} SELECT {CANON} FROM ev")
def dedup_events(spark: SparkSession, d: str) -> DataFrame:
    return _canon(canonical(spark, d))


@query(f"{EV} SELECT event_key, count(*) AS events FROM norm GROUP BY 1")
def event_key_sha(spark: SparkSession, d: str) -> DataFrame:
    return normalized(spark, d).groupBy("event_key").agg(F.count("*").alias("events"))


@query(f"{EV} SELECT event_key, 'run-2' AS run_id, price::DOUBLE AS price FROM ev")
def latest_record_per_key(spark: SparkSession, d: str) -> DataFrame:
    """The same source ingested twice: the second run's rows are the current ones."""
    from datetime import timedelta

    raw = raw_events(spark, d)
    runs = [ev.split(ev.normalize(raw, f"run-{i}", INGESTED + timedelta(hours=i)))[0] for i in (1, 2)]
    return ev.latest(runs[0].unionByName(runs[1])).select("event_key", "run_id", F.col("price").cast("double").alias("price"))


@query(f"{EV} SELECT strftime(event_date, '%Y%m%d')::INT AS date_key, event_date AS full_date, (dayofweek(event_date) + 1)::SMALLINT AS day_of_week, dayname(event_date) AS day_name, weekofyear(event_date)::SMALLINT AS week_of_year, month(event_date)::SMALLINT AS month, monthname(event_date) AS month_name, quarter(event_date)::SMALLINT AS quarter, year(event_date)::SMALLINT AS year, dayofweek(event_date) IN (0, 6) AS is_weekend FROM (SELECT DISTINCT event_date FROM ev)")
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    return star.dim_date(canonical(spark, d))


@query(f"{EV} SELECT category_code, split_part(category_code, '.', 1) AS category_level_1, nullif(split_part(category_code, '.', 2), '') AS category_level_2 FROM (SELECT DISTINCT category_code FROM ev)")
def dim_category(spark: SparkSession, d: str) -> DataFrame:
    return star.dim_category(canonical(spark, d)).select("category_code", "category_level_1", "category_level_2")


@query(f"{EV} SELECT source_product_id, max_by(brand, (event_time, event_key)) AS brand, max_by(category_code, (event_time, event_key)) AS category_code, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_seen_at FROM ev GROUP BY 1")
def dim_product(spark: SparkSession, d: str) -> DataFrame:
    e = canonical(spark, d)
    named = star.dim_product(e).join(star.dim_category(e).select("category_key", "category_code"), "category_key", "left")
    return rounded(named.select("source_product_id", "brand", "category_code", "first_seen_at", "last_seen_at"))


@query(f"{EV} SELECT source_user_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_seen_at FROM ev GROUP BY 1")
def dim_user(spark: SparkSession, d: str) -> DataFrame:
    return rounded(star.dim_user(canonical(spark, d)).select("source_user_id", "first_seen_at", "last_seen_at"))


@query(f"{EV} SELECT CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 ELSE 3 END::SMALLINT AS event_type_key, event_type, count(*) AS events FROM ev GROUP BY 1, 2")
def dim_event_type(spark: SparkSession, d: str) -> DataFrame:
    e = canonical(spark, d)
    return e.join(F.broadcast(star.dim_event_type(e)), "event_type").groupBy("event_type_key", "event_type").agg(F.count("*").alias("events"))


@query(f"{EV} SELECT event_key, strftime(event_date, '%Y%m%d')::INT AS date_key, CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 ELSE 3 END::SMALLINT AS event_type_key, session_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, price::DOUBLE AS price FROM ev")
def fact_behavior_event(spark: SparkSession, d: str) -> DataFrame:
    e = canonical(spark, d)
    return star.fact(e, star.dimensions(e)).select("event_key", "date_key", "event_type_key", "session_id", text_time("event_time"), F.col("price").cast("double").alias("price"))


@query(FUNNEL + """ SELECT *, round(CASE WHEN viewers > 0 THEN cart_users / viewers ELSE 0 END, 6) AS view_to_cart_rate, round(CASE WHEN cart_users > 0 THEN buyers / cart_users ELSE 0 END, 6) AS cart_to_purchase_rate,
  round(CASE WHEN viewers > 0 THEN buyers / viewers ELSE 0 END, 6) AS conversion_rate, round(CASE WHEN cart_users > 0 THEN greatest(0, 1 - buyers / cart_users) ELSE 0 END, 6) AS cart_abandonment_rate FROM users""")
def funnel_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(marts.funnel_daily(canonical(spark, d)))


@query(PRODUCT + " SELECT event_date, product_id, brand, category_code, views, cart_adds, purchase_events, round(revenue, 2) AS revenue, round(CASE WHEN views > 0 THEN cart_adds / views ELSE 0 END, 6) AS view_to_cart_rate, round(CASE WHEN cart_adds > 0 THEN purchase_events / cart_adds ELSE 0 END, 6) AS cart_to_purchase_rate FROM product")
def product_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(marts.product_daily(canonical(spark, d)).withColumn("revenue", F.round("revenue", 2)))


@query(f"{EV}, c AS (SELECT event_date, category_code, {TALLY} FROM ev GROUP BY 1, 2) SELECT event_date, category_code, views, cart_adds, purchase_events, round(revenue, 2) AS revenue, round(CASE WHEN views > 0 THEN purchase_events / views ELSE 0 END, 6) AS conversion_rate FROM c")
def category_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(marts.category_daily(canonical(spark, d)).withColumn("revenue", F.round("revenue", 2)))


@query(DAILY + " SELECT event_date, round(revenue, 2) AS revenue, purchase_events, buyers, round(CASE WHEN purchase_events > 0 THEN revenue / purchase_events ELSE 0 END, 6) AS avg_purchase_value FROM daily")
def daily_revenue(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_revenue(spark, d).withColumn("revenue", F.round("revenue", 2)))


@query(SESSION + " SELECT event_date, session_id, user_id, strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start, strftime(session_end, '%Y-%m-%d %H:%M:%S') AS session_end, duration_seconds, event_count, product_count, view_count, cart_count, purchase_count, session_outcome FROM outcome")
def session_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(marts.session_daily(canonical(spark, d)))


@query(SESSION + " SELECT event_date, session_outcome, count(*) AS sessions, round(avg(duration_seconds), 6) AS mean_seconds FROM outcome GROUP BY 1, 2")
def session_outcomes(spark: SparkSession, d: str) -> DataFrame:
    s = marts.session_daily(canonical(spark, d))
    return rounded(s.groupBy("event_date", "session_outcome").agg(F.count("*").alias("sessions"), F.avg("duration_seconds").alias("mean_seconds")))


@query(PRODUCT + " SELECT product_id, category_code, brand, sum(views)::BIGINT AS views, sum(cart_adds)::BIGINT AS cart_adds, sum(purchase_events)::BIGINT AS purchase_events, round(sum(revenue), 2) AS revenue FROM product GROUP BY 1, 2, 3")
def top_products(spark: SparkSession, d: str) -> DataFrame:
    return rounded(marts.top_products(marts.product_daily(canonical(spark, d))), 2)


@query(SESSION + """, names AS (
  SELECT 'funnel_daily' AS object_name, count(DISTINCT event_date) AS row_count FROM ev UNION ALL SELECT 'product_daily', count(*) FROM (SELECT DISTINCT event_date, source_product_id FROM ev) UNION ALL SELECT 'category_daily', count(*) FROM (SELECT DISTINCT event_date, category_code FROM ev)
  UNION ALL SELECT 'daily_revenue', count(DISTINCT event_date) FROM ev UNION ALL SELECT 'session_daily', count(*) FROM session) SELECT * FROM names""")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return marts.row_counts(marts.marts(canonical(spark, d)))


@query(PRODUCT + " SELECT event_date, product_id, brand, category_code, views, cart_adds, purchase_events, round(revenue, 2) AS revenue FROM product ORDER BY product.revenue DESC, event_date, product_id LIMIT 200")
def detail_top200(spark: SparkSession, d: str) -> DataFrame:
    """A top-200 report: its limit is the feature."""
    return rounded(marts.detail_table(marts.product_daily(canonical(spark, d)).select(*MART_COLUMNS["product_daily"]), "product_daily"), 2)


@query(SESSION + " SELECT event_date, session_id, user_id, strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start, strftime(session_end, '%Y-%m-%d %H:%M:%S') AS session_end, duration_seconds, event_count, purchase_count FROM outcome ORDER BY purchase_count DESC, event_date, session_id LIMIT 200")
def detail_sessions(spark: SparkSession, d: str) -> DataFrame:
    """A top-200 report: its limit is the feature."""
    return rounded(marts.detail_table(marts.session_daily(canonical(spark, d)), "session_daily"))


@query(EV + """, c AS (SELECT count(*) AS n, count(*) - count(DISTINCT event_key) AS dup, count(*) FILTER (event_key IS NULL OR event_time IS NULL OR source_user_id IS NULL OR source_product_id IS NULL) AS miss, count(DISTINCT source_product_id) AS p FROM ev)
SELECT 'silver_not_empty' AS check_name, CASE WHEN n > 0 THEN 'PASSED' ELSE 'FAILED' END AS status, n AS observed_value, '> 0' AS expectation FROM c UNION ALL SELECT 'event_key_unique', CASE WHEN dup = 0 THEN 'PASSED' ELSE 'FAILED' END, dup, '= 0 duplicates' FROM c
UNION ALL SELECT 'required_fields_complete', CASE WHEN miss = 0 THEN 'PASSED' ELSE 'FAILED' END, miss, '= 0 null rows' FROM c UNION ALL SELECT 'fact_has_no_dimension_orphans', 'PASSED', 0, '= 0 orphan rows' UNION ALL SELECT 'product_dimension_not_empty', CASE WHEN p > 0 THEN 'PASSED' ELSE 'FAILED' END, p, '> 0' FROM c""")
def quality_results(spark: SparkSession, d: str) -> DataFrame:
    e = canonical(spark, d)
    return quality.checks(e, star.dimensions(e))


@query(EV + ", part_users AS (SELECT DISTINCT source_user_id FROM ev WHERE event_type = 'view'), part_products AS (SELECT DISTINCT source_product_id FROM ev WHERE event_type = 'purchase') SELECT 'dim_user' AS dimension, count(*) AS orphans FROM ev WHERE source_user_id NOT IN (FROM part_users) UNION ALL SELECT 'dim_product', count(*) FROM ev WHERE source_product_id NOT IN (FROM part_products)")
def orphan_check(spark: SparkSession, d: str) -> DataFrame:
    """Against dimensions that lack users who never viewed and products never bought."""
    e = canonical(spark, d)
    dims = {"dim_user": star.dim_user(e.filter("event_type = 'view'")), "dim_product": star.dim_product(e.filter("event_type = 'purchase'"))}
    return star.orphans(e, dims)


METRIC_ROWS = " SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, event_count, unique_users, round(amount, 4) AS amount FROM m"


@query(METRICS + METRIC_ROWS)
def windowed_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_metrics(spark, d).select("window_start", "event_type", "event_count", "unique_users", "amount"), 4)


@query(METRICS + " SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, event_count, round(amount, 4) AS amount FROM m")
def windowed_metrics_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same windows by Structured Streaming over the events file, through the idempotent sink."""
    from ..streaming import speed

    place = shared_place(spark)
    source = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    stream = metric_events(ev.normalize(raw_events(spark, d, source), "run-1", INGESTED))
    speed.start_metrics(stream, f"{place}/metrics", f"{place}/checkpoint", every=None).awaitTermination()
    return rounded(speed.read_metrics(spark, f"{place}/metrics").select("window_start", "event_type", "event_count", "amount"), 4)


@query(METRICS + " SELECT event_type, strftime(max(window_start), '%Y-%m-%d %H:%M:%S') AS window_start, max_by(event_count, window_start) AS event_count, max_by(unique_users, window_start) AS unique_users, round(max_by(revenue, window_start), 4) AS revenue FROM m GROUP BY 1")
def latest_kpi(spark: SparkSession, d: str) -> DataFrame:
    return rounded(serving.latest_kpi(_metrics(spark, d)).select("event_type", "window_start", "event_count", "unique_users", "revenue"), 4)


@query(METRICS + " SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS t, round(revenue, 4) AS revenue FROM m WHERE event_type = 'purchase' ORDER BY window_start DESC LIMIT 241")
def revenue_series(spark: SparkSession, d: str) -> DataFrame:
    """The newest 241 points: the limit is the feature."""
    return rounded(serving.revenue_series(_metrics(spark, d)), 4)


@query(METRICS + " SELECT event_type, sum(event_count)::BIGINT AS event_count FROM m GROUP BY 1")
def metrics_by_type(spark: SparkSession, d: str) -> DataFrame:
    return serving.by_type(_metrics(spark, d))


@query(METRICS + " SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(sum(revenue), 4) AS revenue FROM m GROUP BY 1")
def revenue_over_time(spark: SparkSession, d: str) -> DataFrame:
    return rounded(serving.over_time(_metrics(spark, d)), 4)


@query(f"{EV} SELECT count(*) AS events FROM norm")
def events_total(spark: SparkSession, d: str) -> DataFrame:
    return serving.total(normalized(spark, d))


@query(f"{EV} SELECT count(DISTINCT source_user_id) AS active_users FROM norm")
def active_users(spark: SparkSession, d: str) -> DataFrame:
    return serving.active_users(metric_events(normalized(spark, d)))


@query(f"{EV} SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS events FROM norm GROUP BY 1")
def date_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(serving.date_histogram(normalized(spark, d)))


def _top(column: str) -> str:
    return f"{EV} SELECT {column}, count(*) AS events FROM norm WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"


@query(_top("event_type"))
def top_event_types(spark: SparkSession, d: str) -> DataFrame:
    return serving.top_terms(normalized(spark, d), "event_type")


@query(_top("brand"))
def top_brands(spark: SparkSession, d: str) -> DataFrame:
    return serving.top_terms(normalized(spark, d), "brand")


@query(_top("category_code"))
def top_categories(spark: SparkSession, d: str) -> DataFrame:
    return serving.top_terms(normalized(spark, d), "category_code")


def _stat(f: str) -> str:
    return f"SELECT '{f}' AS feature, count({f}) AS n, round(avg({f}), 6) AS mean, round(stddev_samp({f}), 6) AS std, round(min({f}), 6)::DOUBLE AS min, round(quantile_cont({f}, 0.25), 6) AS q1, round(quantile_cont({f}, 0.5), 6) AS median, round(quantile_cont({f}, 0.75), 6) AS q3, round(max({f}), 6)::DOUBLE AS max, round(stddev_samp({f}) / avg({f}) * 100, 6) AS cv FROM feat"


@query(DAILY + " " + " UNION ALL ".join(_stat(f) for f in quality.FEATURES))
def series_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.profile(_revenue(spark, d)))


@query(DAILY + " SELECT (count(*) FILTER (revenue IS NULL) + count(*) FILTER (purchase_events IS NULL) + count(*) FILTER (avg_purchase_value IS NULL))::BIGINT AS null_cells, count(event_date) - count(DISTINCT event_date) AS duplicate_days FROM feat")
def series_gaps(spark: SparkSession, d: str) -> DataFrame:
    return quality.gaps(_revenue(spark, d))


@query(DAILY + ", bought AS (SELECT event_date FROM daily WHERE buyers >= (SELECT avg(buyers) FROM daily)) SELECT unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY))::DATE AS event_date FROM bought EXCEPT SELECT event_date FROM bought")
def missing_days(spark: SparkSession, d: str) -> DataFrame:
    """Calendar days missing between the days with an average number of buyers or more."""
    r = _revenue(spark, d)
    return quality.missing_days(r.join(F.broadcast(r.agg(F.avg("buyers").alias("mean"))), F.col("buyers") >= F.col("mean")).select("event_date"))


@query(DAILY + " SELECT ((dayofweek(event_date) + 6) % 7)::INT AS weekday, round(avg(revenue), 6) AS mean_revenue, count(*) AS days, round(quantile_cont(revenue, 0.25), 6) AS q1, round(quantile_cont(revenue, 0.5), 6) AS median, round(quantile_cont(revenue, 0.75), 6) AS q3 FROM feat GROUP BY 1")
def weekday_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.weekday_stats(_revenue(spark, d)))


@query(DAILY + " SELECT 'revenue' AS a, 'purchase_events' AS b, round(corr(revenue, purchase_events), 6) AS pearson FROM feat UNION ALL SELECT 'revenue', 'avg_purchase_value', round(corr(revenue, avg_purchase_value), 6) FROM feat UNION ALL SELECT 'purchase_events', 'avg_purchase_value', round(corr(purchase_events, avg_purchase_value), 6) FROM feat")
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.correlations(_revenue(spark, d)))


@query(DAILY + """, long AS (SELECT event_date, unnest(['revenue', 'purchase_events', 'avg_purchase_value']) AS feature, unnest([revenue, purchase_events::DOUBLE, avg_purchase_value]) AS value FROM feat
), q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1) SELECT feature, event_date, round(value, 6) AS value FROM long JOIN q USING (feature) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.iqr_outliers(_revenue(spark, d)))


@query(SERIES + " SELECT series, date, round(CASE WHEN count(revenue) OVER w = 3 THEN avg(revenue) OVER w END, 6) AS rolling_mean FROM hist WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)")
def rolling_mean_3(spark: SparkSession, d: str) -> DataFrame:
    h = _series(spark, d).withColumnRenamed("date", "event_date")
    return rounded(quality.rolling_mean(h, ("series",)).select("series", F.col("event_date").alias("date"), "rolling_mean"))


@query(DAILY + ", ends AS (SELECT min(revenue) AS lo, max(revenue) AS hi FROM feat) SELECT least(10, 1 + floor((revenue - lo) / (hi - lo) * 10)::INT) AS bin, count(*) AS days FROM feat, ends WHERE hi > lo GROUP BY 1")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.histogram(_revenue(spark, d))


@query(SERIES + " SELECT series, date, round(revenue, 2) AS revenue, purchase_events, round(avg_purchase_value, 6) AS avg_purchase_value FROM hist")
def daily_series(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_series(spark, d).withColumn("revenue", F.round("revenue", 2)))


@query(SERIES + """, days AS (SELECT series, unnest(generate_series(min(date), max(date) + 60, INTERVAL 1 DAY))::DATE AS date FROM hist GROUP BY 1), k AS (SELECT *, (dayofweek(date) + 6) % 7 AS wd FROM days)
SELECT series, date, round(sin(2 * pi() * wd / 7), 6) + 0.0 AS dow_sin, round(cos(2 * pi() * wd / 7), 6) AS dow_cos, CASE WHEN wd >= 5 THEN 1.0 ELSE 0.0 END::DOUBLE AS is_weekend FROM k""")
def calendar_covariates(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.calendar_covariates(_series(spark, d)))


@query(NAIVE + " SELECT series, forecast_date, model, round(predicted_revenue, 6) AS predicted_revenue FROM naive")
def naive_forecast(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.naive_forecast(_series(spark, d)))


@query(NAIVE + " SELECT series, date, round(revenue, 6) AS actual_revenue, NULL::VARCHAR AS model, NULL::DOUBLE AS predicted_revenue FROM hist UNION ALL SELECT series, forecast_date, NULL, model, round(predicted_revenue, 6) FROM naive")
def revenue_forecast_view(spark: SparkSession, d: str) -> DataFrame:
    h = _series(spark, d)
    return rounded(series.forecast_view(h, series.naive_forecast(h)))


@query(FOLDS + " SELECT series, fold::INT AS fold, test_start, test_end, model, round(mae, 6) AS mae, round(mse, 4) AS mse, round(rmse, 6) AS rmse, round(mape, 6) AS mape FROM detail")
def backtest_detail(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.backtest_detail(_series(spark, d)).withColumn("mse", F.round("mse", 4)))


@query(FOLDS + " SELECT series, model, round(avg(mae), 6) AS mae, round(avg(mse), 4) AS mse, round(avg(rmse), 6) AS rmse, round(avg(mape), 6) AS mape, count(DISTINCT fold) AS folds FROM detail GROUP BY 1, 2")
def naive_backtest(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.backtest(series.backtest_detail(_series(spark, d))).withColumn("mse", F.round("mse", 4)))


@query(NAIVE + " SELECT model, count(*) AS forecast_points, round(avg(predicted_revenue), 2) AS avg_pred FROM naive GROUP BY 1")
def forecast_model_stats(spark: SparkSession, d: str) -> DataFrame:
    return series.model_stats(series.naive_forecast(_series(spark, d)))


@query(NAIVE + " SELECT forecast_date, model, round(sum(predicted_revenue), 6) AS predicted_revenue FROM naive GROUP BY 1, 2")
def predicted_by_day(spark: SparkSession, d: str) -> DataFrame:
    return rounded(serving.predicted_by_day(series.naive_forecast(_series(spark, d))))


@query(ANOMALY + """, one AS (SELECT * FROM anomaly WHERE series = 'all'), l AS (SELECT round(greatest(avg(revenue), 0), 2) AS p FROM (SELECT revenue FROM one ORDER BY date DESC LIMIT 7))
SELECT count(*) AS days, min(date) AS min_day, max(date) AS max_day, round(avg(revenue), 6) AS mean_revenue, 7::BIGINT AS horizon_days, 'naive7' AS models, (SELECT p FROM l) AS mean_naive7, count(*) FILTER (anomaly_label = 1) AS flagged_days,
  round(count(*) FILTER (anomaly_label = 1) / count(*), 6) AS flagged_rate, CASE WHEN count(*) < 14 THEN 'fewer than 14 days: the backtest says little' END AS warning FROM one""")
def ml_report(spark: SparkSession, d: str) -> DataFrame:
    h = _series(spark, d).filter("series = 'all'")
    found = series.zscore_anomalies(h).filter("anomaly_label = 1")
    r = series.report(h, series.naive_forecast(h), found)
    return rounded(r.select("days", "min_day", "max_day", "mean_revenue", "horizon_days", "models", F.col("mean_predicted_by_model")["naive7"].alias("mean_naive7"), "flagged_days", "flagged_rate", "warning"))


@query(ANOMALY + " SELECT series, date, round(revenue, 6) AS revenue, purchase_events, round(avg_purchase_value, 6) AS avg_purchase_value, round(anomaly_score, 6) AS anomaly_score, anomaly_label FROM anomaly")
def zscore_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.zscore_anomalies(_series(spark, d)))


@query(ANOMALY + " SELECT series, date, round(anomaly_score, 6) AS anomaly_score FROM anomaly ORDER BY anomaly.anomaly_score DESC, series, date LIMIT 10")
def anomaly_top10(spark: SparkSession, d: str) -> DataFrame:
    """A top-10 report: its limit is the feature."""
    a = series.zscore_anomalies(_series(spark, d))
    return rounded(a.orderBy(F.desc("anomaly_score"), "series", "date").limit(10).select("series", "date", "anomaly_score"))


@query(ANOMALY + " SELECT date AS event_date, round(max(anomaly_score), 6) AS anomaly_score FROM anomaly WHERE anomaly_label = 1 GROUP BY 1")
def anomaly_by_day(spark: SparkSession, d: str) -> DataFrame:
    a = series.zscore_anomalies(_series(spark, d)).filter("anomaly_label = 1").withColumnRenamed("date", "event_date")
    return rounded(serving.score_by_day(a))


@query()
def pca_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.pca_anomalies(_series(spark, d)))


@query()
def anomaly_stability(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.stability(_series(spark, d)))


@query()
def ridge_forecast(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.forecast(_series(spark, d)))


@query(f"{EV} SELECT 'events' AS source, rejection_reason AS error, 'ContractError' AS error_type, event_type, event_key FROM norm WHERE rejection_reason IS NOT NULL")
def dlq_records(spark: SparkSession, d: str) -> DataFrame:
    dead = ev.dead_letters(ev.split(normalized(spark, d))[1], "events")
    return dead.select("source", "error", "error_type", F.get_json_object("raw_payload", "$.event_type").alias("event_type"), F.get_json_object("raw_payload", "$.event_key").alias("event_key"))


@query(f"{EV} SELECT session_id AS key, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS event_time, event_type, source_product_id AS product_id FROM ev")
def wire_events(spark: SparkSession, d: str) -> DataFrame:
    wire = ev.to_wire(canonical(spark, d))
    return wire.select("key", *(F.get_json_object("value", f"$.{c}").alias(c) for c in ("event_time", "event_type", "product_id")))


@query(PRICE + " SELECT day, site, product_id, product_name, brand, round(price, 8) AS price, round(list_price, 8) AS list_price, currency, in_stock FROM marked WHERE rejection_reason IS NULL")
def price_snapshots(spark: SparkSession, d: str) -> DataFrame:
    good, _ = prices.split_prices(prices.normalize_prices(raw_prices(spark, d)))
    return rounded(good.select(F.date_format("snapshot_time", "yyyy-MM-dd").alias("day"), "site", "product_id", "product_name", "brand", "price", "list_price", "currency", "in_stock"), 8)


@query(PRICE + " SELECT site, count(*) AS snapshots, count(*) FILTER (rejection_reason IS NOT NULL) AS rejected, count(*) FILTER (price > list_price) AS above_list FROM marked GROUP BY 1")
def price_quality(spark: SparkSession, d: str) -> DataFrame:
    p = prices.normalize_prices(raw_prices(spark, d)).withColumn("why", prices.price_problem())
    return p.groupBy("site").agg(F.count("*").alias("snapshots"), F.count("why").alias("rejected"), F.count_if(F.col("price") > F.col("list_price")).alias("above_list"))
