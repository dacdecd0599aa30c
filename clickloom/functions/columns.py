"""Small column builders used everywhere: NULL-safe under ANSI mode, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_present(df: DataFrame, names: list[str], kind: str = "string", default: object = None) -> Column:
    """The first non-null of those columns that df has, cast leniently; `default` (or NULL) where there is none."""
    known = [F.col(f"`{n}`").try_cast(kind) if kind != "string" else F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    last = F.lit(default).cast(kind)
    return F.coalesce(*known, last) if known else last


def ratio(top: str, bottom: str) -> Column:
    """top / bottom as double; 0.0 where bottom isn't positive."""
    return F.expr(f"CASE WHEN {bottom} > 0 THEN CAST({top} AS DOUBLE) / {bottom} ELSE 0.0D END")


def blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(name) == "")


def date_key(name: str) -> Column:
    return F.date_format(name, "yyyyMMdd").cast("int")


def category_level(name: str, level: int) -> Column:
    return F.get(F.split(name, "\\."), level)


def iso_time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
