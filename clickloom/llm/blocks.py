"""Documents dealt into blocks of bounded size, so that a block's vocabulary can be looked up with one shuffle."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of about `block_bytes` of text, and no fewer than two for each core so that small inputs spread too."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(math.ceil(total / block_bytes), 2 * docs.sparkSession.sparkContext.defaultParallelism)


def in_blocks(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text, block (one of n). The block hangs on the id and the text, so copies of one id spread as well."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block"))
