"""Price snapshots: a site's listing payload to the price contract, with reasons for rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import PRICE_SCHEMA
from ..functions.columns import first_present

LISTING_SCHEMA = "data array<struct<id:bigint,name:string,price:double,list_price:double,original_price:double,brand_name:string,rating_average:double,review_count:int,url_key:string,seller_id:bigint,availability:int,shippable:boolean>>"


def from_listing(pages: DataFrame, category: str, product_url: str, currency: str = "VND") -> DataFrame:
    """One row a product of listing payloads (column `data`). product_url: a format string of url_key and id."""
    p = pages.select(F.explode("data").alias("p")).select("p.*")
    some = lambda c: F.nullif(F.col(c), F.lit(0.0))
    url = F.when((F.col("url_key") != "") & F.col("id").isNotNull() & (F.col("id") != 0), F.format_string(product_url, "url_key", F.col("id").cast("string"))).otherwise("")
    return p.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("product_id"), F.coalesce("name", F.lit("")).alias("product_name"), F.lit(category).alias("category_path"), F.coalesce("brand_name", F.lit("")).alias("brand"),
        "price", F.coalesce(some("list_price"), some("original_price"), F.col("price")).alias("list_price"), F.lit(currency).alias("currency"), F.col("rating_average").alias("rating"), "review_count",
        F.coalesce(F.concat(F.lit("seller:"), F.col("seller_id").cast("string")), F.lit("")).alias("seller_name"),
        ((F.coalesce("availability", F.lit(1)) != 0) & F.coalesce("shippable", F.lit(True))).alias("in_stock"), url.alias("url"))


def normalize_prices(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """The price contract's 14 columns; texts trimmed, numbers cast leniently, missing stock counts as in stock."""
    defaults = {"currency": "VND"}
    cells = []
    for f in PRICE_SCHEMA.fields:
        kind = f.dataType.simpleString()
        if f.name == "snapshot_time":
            given = F.try_to_timestamp(F.col("snapshot_time").cast("string")) if "snapshot_time" in raw.columns else F.lit(None).cast("timestamp")
            cell = F.coalesce(given, now if now is not None else F.current_timestamp())
        elif kind == "string":
            given = F.trim(first_present(raw, [f.name], default=""))
            cell = F.when(given == "", defaults[f.name]).otherwise(given) if f.name in defaults else F.lower(given) if f.name == "site" else given
        elif kind == "boolean":
            cell = first_present(raw, [f.name], "boolean", True)
        else:
            cell = first_present(raw, [f.name], kind)
        cells.append(cell.alias(f.name))
    return raw.select(*cells)


def price_problem() -> Column:
    """The first rule of the price contract that a snapshot breaks, NULL if none."""
    rules = [
        (F.col("site") == "", "missing_site"), (F.col("product_id") == "", "missing_product_id"), (F.col("price").isNull(), "missing_price"),
        (F.col("price") < 0, "negative_price"), (F.col("list_price") < 0, "negative_list_price"),
    ]
    return F.coalesce(*(F.when(broken, F.lit(name)) for broken, name in rules))


def split_prices(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = snapshots.withColumn("rejection_reason", price_problem())
    return marked.filter("rejection_reason IS NULL").drop("rejection_reason"), marked.filter("rejection_reason IS NOT NULL")
