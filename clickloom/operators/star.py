"""The star schema: day by day from canonical events, and dimensions merged from days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import TYPE_KEYS
from ..functions.columns import category_level, date_key

# fixed values: the columns of the date dimension after its key, as expressions of the day
CALENDAR = {
    "full_date": "d", "day_of_week": "smallint(dayofweek(d))", "day_name": "date_format(d, 'EEEE')", "week_of_year": "smallint(weekofyear(d))", "month": "smallint(month(d))",
    "month_name": "date_format(d, 'MMMM')", "quarter": "smallint(quarter(d))", "year": "smallint(year(d))", "is_weekend": "weekday(d) >= 5",
}
PARTS = ("dim_user", "dim_product", "dim_category")  # dimensions that are kept as parts of days
_SIGHT = {"dim_user": ("source_user_id", ()), "dim_product": ("source_product_id", ("brand", "category_code"))}


def calendar(days: DataFrame) -> DataFrame:
    """The date dimension of the days in a column `d`, each given once."""
    return days.select(date_key("d").alias("date_key"), *(F.expr(e).alias(n) for n, e in CALENDAR.items()))


def dimension_parts(events: DataFrame, *by: str) -> dict[str, DataFrame]:
    """What events say of users, products and categories, for each value of `by` (a day, say); `merged` makes dimensions of any parts."""
    out = {}
    for name, (key, attributes) in _SIGHT.items():
        now = F.max(F.struct("event_time", "event_key", *attributes)).alias("now")
        out[name] = events.groupBy(*by, key).agg(F.min("event_time").alias("first_seen_at"), F.max("event_time").alias("last_seen_at"), now)
    code = F.coalesce("category_code", F.lit("unknown")).alias("category_code")
    return out | {"dim_category": events.groupBy(*by, code).agg(F.min("category_id").alias("category_id"))}


def merged(name: str, parts: DataFrame) -> DataFrame:
    """A dimension from its parts: first and last sight over all days, the latest attributes; keys are hashes, so none is looked up."""
    if name == "dim_category":
        d = parts.groupBy("category_code").agg(F.min("category_id").alias("category_id"))
        return d.select(F.xxhash64("category_code").alias("category_key"), "category_id", "category_code", *(category_level("category_code", i).alias(f"category_level_{i + 1}") for i in (0, 1)))
    key, attributes = _SIGHT[name]
    d = parts.groupBy(key).agg(F.max("now").alias("now"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    latest = {"category_key": F.xxhash64(F.coalesce("now.category_code", F.lit("unknown"))), "brand": F.col("now.brand")} if attributes else {}
    return d.select(F.xxhash64(key).alias(name.removeprefix("dim_") + "_key"), key, *(v.alias(k) for k, v in latest.items()), "first_seen_at", "last_seen_at")


def dim_date(events: DataFrame) -> DataFrame:
    return calendar(events.select(F.col("event_date").alias("d")).distinct())


def dim_category(events: DataFrame) -> DataFrame:
    return merged("dim_category", dimension_parts(events)["dim_category"])


def dim_product(events: DataFrame) -> DataFrame:
    """Latest brand and category with first and last sight."""
    return merged("dim_product", dimension_parts(events)["dim_product"])


def dim_user(events: DataFrame) -> DataFrame:
    return merged("dim_user", dimension_parts(events)["dim_user"])


def dim_event_type(events: DataFrame) -> DataFrame:
    """The three event types and their keys."""
    return events.sparkSession.createDataFrame([(k, t) for t, k in TYPE_KEYS.items()], "event_type_key short, event_type string")


def dimensions(events: DataFrame) -> dict[str, DataFrame]:
    return {f.__name__: f(events) for f in (dim_date, dim_category, dim_product, dim_user)}


# fixed values: the fact's columns, in order
FACT = "event_key date_key user_key product_key event_type_key session_id event_time price source_file run_id ingested_at".split()


def fact(events: DataFrame, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row an event whose user and product are known. Keys come with the dimensions; the three types are broadcast.

    Without dims all are known, as behind the gate: keys are hashes, so nothing is looked up and events aren't shuffled.
    """
    out = events.join(F.broadcast(dim_event_type(events)), "event_type", "left").withColumn("date_key", date_key("event_date"))
    for name, (key, _) in _SIGHT.items():
        of = name.removeprefix("dim_") + "_key"
        out = out.withColumn(of, F.xxhash64(key)) if dims is None else out.join(dims[name].select(key, of), key)
    return out.select(*FACT)


def orphans(events: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """dimension, orphans: events without a row in the dimension; they are counted by key first, so only keys are shuffled."""
    lost = [events.groupBy(k).agg(F.count("*").alias("n")).join(dims[d], k, "left_anti").agg(F.lit(d).alias("dimension"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")) for d, (k, _) in _SIGHT.items()]
    return lost[0].union(lost[1])
