"""Behavioral events: any raw table to the one contract, reasons for rejection, deduplication by content."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contract import ALIASES, TYPE_KEYS
from ..functions.columns import blank, first_present, iso_time

KEY_PARTS = ("event_type", "source_user_id", "source_product_id", "session_id")


def _event_type(raw: DataFrame) -> Column:
    plain = F.lower(F.trim(first_present(raw, ["event_type"], default="")))
    renamed = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))[plain]
    return F.coalesce(renamed, plain)


def _event_time(raw: DataFrame, strict: bool) -> Column:
    """Text times (a closing ` UTC` is dropped), then seconds since 1970 in `timestamp`."""
    texts = ["event_time", "order_date"] if strict else ["event_time"]
    tries = []
    for name in texts:
        if name in raw.columns:
            kind = dict(raw.dtypes)[name]
            tries.append(F.col(name).cast("timestamp") if kind.startswith(("timestamp", "date")) else F.try_to_timestamp(F.regexp_replace(F.col(name).cast("string"), " UTC$", "")))
    if "timestamp" in raw.columns:
        tries.append(F.timestamp_seconds(F.col("timestamp").cast("string").try_cast("bigint")))
    return F.coalesce(*tries) if tries else F.lit(None).cast("timestamp")


def event_key() -> Column:
    """SHA-256 over type, user, product, session and time to the second; price and fractions are left out by contract."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in KEY_PARTS]
    second = F.coalesce(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return F.sha2(F.concat_ws("||", *parts, second), 256)


def normalize(raw: DataFrame, run_id: str, ingested_at: datetime, strict_contract: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """The contract's 14 columns, whatever optional columns raw has; others are dropped but those named in extra.

    strict_contract adds the row contract's aliases (customer_id, order_date), trims strings and names blank categories.
    """
    product = first_present(raw, ["product_id"])
    if "product_ids" in raw.columns:
        product = F.coalesce(product, F.try_element_at("product_ids", F.lit(1)).cast("string"))
    texts = {
        "source_user_id": first_present(raw, ["user_id", "customer_id"] if strict_contract else ["user_id"]),
        "source_product_id": product,
        "category_id": first_present(raw, ["category_id"]),
        "category_code": first_present(raw, ["category_code", "category"], default="unknown"),
        "brand": first_present(raw, ["brand"]),
        "session_id": first_present(raw, ["user_session", "session_id"]),
    }
    if strict_contract:
        texts = {k: F.trim(v) for k, v in texts.items()}
        texts["category_code"] = F.when(texts["category_code"] == "", "unknown").otherwise(texts["category_code"])
    out = raw.select(
        _event_type(raw).alias("event_type"), *(v.alias(k) for k, v in texts.items()), _event_time(raw, strict_contract).alias("event_time"),
        F.coalesce(first_present(raw, ["price"], "decimal(18,4)"), first_present(raw, ["total_amount"], "decimal(18,4)")).alias("price"),
        first_present(raw, ["_source_file"], default="unknown").alias("source_file"), F.lit(run_id).alias("run_id"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"), *extra)
    return out.withColumn("event_date", F.to_date("event_time")).withColumn("event_key", event_key())


def rejection_reason() -> Column:
    """Why a normalized event breaks the contract, by the first rule that it breaks; NULL if it keeps all."""
    rules = [
        (~F.col("event_type").isin(*TYPE_KEYS), "unsupported_event_type"), (F.col("event_time").isNull(), "missing_event_time"),
        (blank("source_user_id"), "missing_user_id"), (blank("source_product_id"), "missing_product_id"), (F.col("price") < 0, "negative_price"),
    ]
    return F.coalesce(*(F.when(broken, F.lit(name)) for broken, name in rules))


def one_per_key(events: DataFrame, *order: Column) -> DataFrame:
    """One row of each event_key: the first by `order`, ties broken by time and price so that reruns agree."""
    w = Window.partitionBy("event_key").orderBy(*order, F.col("event_time"), F.col("price"))
    return events.withColumn("place", F.row_number().over(w)).filter("place = 1").drop("place")


def split(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events, one of each key, and rejected ones with rejection_reason."""
    marked = events.withColumn("rejection_reason", rejection_reason())
    return one_per_key(marked.filter("rejection_reason IS NULL").drop("rejection_reason")), marked.filter("rejection_reason IS NOT NULL")


def latest(silver: DataFrame) -> DataFrame:
    """The row of each event_key that was ingested last."""
    return one_per_key(silver, F.desc("ingested_at"), F.desc("run_id"))


def to_wire(events: DataFrame) -> DataFrame:
    """key (session, else user) and value (JSON with ISO time) as an event is published."""
    none = lambda c: F.when(F.trim(c) != "", F.col(c))
    fields = {
        "event_time": iso_time("event_time"), "event_type": F.col("event_type"), "product_id": F.col("source_product_id"), "category_id": F.col("category_id"),
        "category_code": F.col("category_code"), "brand": F.col("brand"), "price": F.col("price").cast("double"), "user_id": F.col("source_user_id"), "user_session": F.col("session_id"),
    }
    return events.select(F.coalesce(none("session_id"), none("source_user_id")).alias("key"), F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))).alias("value"))


def index_documents(raw: DataFrame) -> DataFrame:
    """Documents of a raw-event index: id, @timestamp (event time, else now), ingest_timestamp and known fields without nulls."""
    fields = [c for c in ("event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session") if c in raw.columns]
    at = F.coalesce(_event_time(raw, False), F.current_timestamp())
    key = F.sha2(F.concat_ws("||", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields), F.coalesce(_event_time(raw, False).cast("string"), F.lit(""))), 256)
    given = F.col("event_id").cast("string") if "event_id" in raw.columns else F.lit(None).cast("string")
    doc = F.struct(at.alias("@timestamp"), F.current_timestamp().alias("ingest_timestamp"), *fields)
    return raw.select(F.coalesce(given, key).alias("id"), F.to_json(doc).alias("document"))


def dead_letters(rejected: DataFrame, source: str, reason: str = "rejection_reason", at: Column | None = None) -> DataFrame:
    """source, error, error_type, failed_at, raw_payload (JSON) of each rejected row."""
    payload = F.to_json(F.struct(*(c for c in rejected.columns if c != reason)))
    return rejected.select(F.lit(source).alias("source"), F.col(reason).alias("error"), F.lit("ContractError").alias("error_type"), (at if at is not None else F.current_timestamp()).cast("string").alias("failed_at"), payload.alias("raw_payload"))
