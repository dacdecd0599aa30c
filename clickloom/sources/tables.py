"""The given tables (events, part, lineitem, supplier) as raw input of the contracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev

INGESTED = datetime(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events in the raw source's columns: clicks are carts, the product is the number in props, its category from part."""
    e = table(spark, sf_dir, "events") if events is None else events
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr("lower(concat(p_type, '.', split_part(p_name, ' ', 2)))").alias("category_code"), F.col("p_brand").alias("brand"))
    e = e.withColumn("product_id", F.get_json_object("props", "$.k"))
    e = e.join(part, F.col("product_id").try_cast("bigint") == part.p_partkey, "left")
    day, user = F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string")
    return e.select(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC")).alias("event_time"), F.expr("CASE WHEN event_type = 'click' THEN 'add_to_cart' WHEN event_type = 'view' THEN 'page_view' ELSE event_type END").alias("event_type"),
        "product_id", "category_code", "brand", F.col("value").alias("price"), user.alias("user_id"), F.concat_ws("-", user, day).alias("user_session"))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.normalize(raw_events(spark, sf_dir), "run-1", INGESTED)


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.split(normalized(spark, sf_dir))[0]


def metric_events(normal: DataFrame) -> DataFrame:
    """The columns that windowed metrics read, of all events as they come."""
    return normal.select("event_time", "event_type", F.col("source_user_id").alias("user_id"), F.col("price").cast("double").alias("price"))


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price snapshots from order lines: the unit price paid, the part's list price, the supplier as site."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_linestatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    d = line.join(part, line.l_partkey == part.p_partkey, "left").join(supplier, line.l_suppkey == supplier.s_suppkey, "left")
    return d.select(
        F.col("l_shipdate").alias("snapshot_time"), F.col("s_name").alias("site"), F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category_path"),
        F.col("p_brand").alias("brand"), F.expr("CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END").alias("price"), F.col("p_retailprice").alias("list_price"), (F.col("l_linestatus") == "O").alias("in_stock"))
