"""Reading: raw files of any schema, listing payloads, streams, and where zones live."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import WIRE_SCHEMA

ZONES = ("bronze", "silver", "gold", "audit")


def zone_uri(base: str, zone: str, dataset: str = "") -> str:
    """The folder of a dataset in a zone under any base URI (file, s3a, hdfs ...)."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate((base, zone, dataset)) if p)


def s3a_options(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    """Session settings for an S3-compatible store."""
    p = "spark.hadoop.fs.s3a."
    return {p + "endpoint": endpoint, p + "access.key": access_key, p + "secret.key": secret_key, p + "path.style.access": "true", p + "connection.ssl.enabled": str(ssl).lower(), p + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header (all columns text) if the path names one, else JSON lines; _source_file tells each row's file."""
    reader = spark.read.option("header", True).option("escape", '"')
    raw = reader.csv(path) if ".csv" in path.lower() else spark.read.json(path)
    return raw.withColumn("_source_file", F.col("_metadata.file_path"))


def decode_all(messages: DataFrame) -> DataFrame:
    """Wire JSON in `value` to contract columns, with decode_error: not_json, no_event_type, unreadable_time, or NULL. value stays where there is an error."""
    text = F.col("value").cast("string")
    e = messages.select(text.alias("value"), F.try_parse_json(text).isNull().alias("broken"), F.from_json(text, WIRE_SCHEMA).alias("e")).select("value", "broken", "e.*")
    e = e.withColumn("event_time", F.try_to_timestamp(F.regexp_replace("event_time", " UTC$", "")))
    error = F.when(F.col("broken"), "not_json").when(F.col("event_type").isNull(), "no_event_type").when(F.col("event_time").isNull(), "unreadable_time")
    e = e.withColumn("decode_error", error).drop("broken")
    return e.withColumn("value", F.when(F.col("decode_error").isNotNull(), F.col("value")))


def decode(messages: DataFrame) -> DataFrame:
    """Wire JSON in `value` to contract columns; rows that aren't JSON, without type or without a readable time go."""
    return decode_all(messages).filter("decode_error IS NULL").drop("decode_error", "value")


def read_stream(spark: SparkSession, format: str = "text", path: str | None = None, **options: str) -> DataFrame:  # noqa: A002
    """A stream of messages with a `value` column. For kafka give its options; it starts at the latest and survives lost offsets."""
    defaults = {"startingOffsets": "latest", "failOnDataLoss": "false"} if format == "kafka" else {}
    reader = spark.readStream.format(format).options(**defaults | options)
    return reader.load(path) if path else reader.load()
