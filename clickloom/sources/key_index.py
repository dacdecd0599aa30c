"""Bloom filters of a key for each folder of a table, built and probed by DataFrame functions.

A filter is as many blocks of 32,768 bits as its folder's distinct keys need at BITS bits a key. A key belongs to one block
and sets PROBES bits there, so a block is one row and keys meet filters in a join by block. A key that isn't in a folder
passes with a probability of about 6e-6; what is read for it in vain changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, PROBES = 32, 8
_BLOCK = 1 << 15


def _places(hashed: Column) -> Column:
    """The bits of a key: 15 of each of two further hashes at a time."""
    parts = [F.shiftrightunsigned(F.xxhash64(F.lit(seed), hashed), 16 * i).bitwiseAND(F.lit(_BLOCK - 1)) for seed in range(PROBES // 4) for i in range(4)]
    return F.array(*parts)


def filters(rows: DataFrame, key: str, folder: list[str]) -> DataFrame:
    """The folder columns, blocks (of its filter), block and bits of each filter's block; null keys are in no filter."""
    keys = rows.filter(F.col(key).isNotNull()).select(*folder, F.xxhash64(key).alias("h")).distinct()
    size = keys.groupBy(*folder).agg(F.count("*").alias("n"))
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") * BITS / _BLOCK, F.lit(1))))).cast("long")
    keys = keys.join(size.withColumn("blocks", blocks), folder).withColumn("block", F.pmod("h", "blocks"))
    bits = keys.select(*folder, "blocks", "block", F.explode(_places(F.col("h"))).alias("bit"))
    return bits.groupBy(*folder, "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def shard_name(hashed: Column, shards: Column) -> Column:
    """The shard of a hash, as `number-shards`."""
    return F.concat_ws("-", F.pmod(hashed, shards).cast("string"), shards.cast("string"))


def folders_with(keys: DataFrame, key: str, index: DataFrame, folder: list[str], shard: str | None = None) -> DataFrame:
    """The folders that may hold any of the keys: all that do, and few others.

    shard: the folder column with `shard_name` of its keys, so that a key meets the filters of its own shard only.
    """
    shards = F.split(shard, "-")[1].cast("long") if shard else F.lit(1).cast("long")
    index = index.withColumn("shards", shards)
    sizes = sorted((r.blocks, r.shards) for r in index.select("blocks", "shards").distinct().collect())  # powers of two, and shards by run size: hundreds of rows
    if not sizes:
        return index.select(*folder)
    hashed = keys.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h")).distinct()
    hashed = hashed.select("h", F.inline(F.array(*(F.struct(F.lit(b).cast("long").alias("blocks"), F.lit(n).cast("long").alias("shards")) for b, n in sizes))))
    probe = hashed.select("blocks", "shards", F.pmod("h", "blocks").alias("block"), *([shard_name(F.col("h"), F.col("shards")).alias(shard)] if shard else []), _places(F.col("h")).alias("places"))
    met = index.join(probe, ["blocks", "shards", "block", *([shard] if shard else [])])
    byte = lambda p: F.conv(F.hex(F.substring("bits", (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return met.filter(F.forall("places", lambda p: byte(p).bitwiseAND(F.pow(F.lit(2), p % 8).cast("int")) > 0)).select(*folder).distinct()
