"""Sharding by jump consistent hashing, with gapless slots inside each shard.

The shard of a key depends on the key and the number of shards alone. When a shard is appended, a row
either stays or moves into the new shard, and only the necessary share moves. No ring table is kept.

Slots are numbered in two steps, so that no task holds a whole shard: rows are dealt into chunks by a
hash of what they show, the chunks' sizes are summed up into offsets, and each chunk numbers its own rows. Rows
that are equal are counted first and numbered as one, so that a repeated row fills no chunk.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Fixed values of the published algorithm: the multiplier of its linear congruential generator.
JUMP_MULTIPLIER = np.uint64(2862933555777941757)
#: Chunks of a shard. Their number bounds the offsets table, whatever the number of rows.
CHUNKS = 1024


def jump_buckets(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key among ``shards``."""
    if shards < 1:
        raise ValueError("shards must be positive")
    state = keys.astype(np.uint64)
    bucket = np.full(len(state), -1, np.int64)
    jump = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        bucket[live] = jump[live]
        with np.errstate(over="ignore"):
            state[live] = state[live] * JUMP_MULTIPLIER + np.uint64(1)
        step = (bucket[live] + 1) * (float(1 << 31) / ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))
        jump[live] = step.astype(np.int64)
        live = live[jump[live] < shards]
    return bucket


def mixed_keys(ids: np.ndarray) -> np.ndarray:
    """64-bit keys of integer ids, by the finaliser of splitmix64, so that runs of ids spread."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long column; a null key counts as 0."""

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(jump_buckets(mixed_keys(ids.to_numpy(np.int64)), shards).astype(np.int32))

    return shard(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def assign_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, size (UTF-8 bytes of the text and 1), text_crc32 (unsigned), law
    ('key': the id and the number of shards decide), shard, slot (gapless from 0 in the shard), grown_shard
    (with one more shard; equal to shard or the new one).

    Null texts have size 1 and the crc32 of nothing, 0, as empty texts do. A null id is sharded like 0.
    Rows that repeat an id share its shard and have slots of their own; slots follow a hash of id, crc32 and size,
    then these. Other columns are not read; an empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.col(id_col).cast("long")
    # crc32 is a built-in of Spark over the text's bytes; sizes need no copy of the text either
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"))
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    rows = stored(rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(CHUNKS)).cast("int")), "shards")
    chunks = rows.groupBy("shard", "chunk").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "chunk").orderBy("id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "chunk"])
    numbered = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("start") + F.col("copy")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id") -> None:
    """``docs`` written as Parquet under ``path``, a folder ``shard=k`` for each shard that has rows; null ids go with id 0.

    A column named shard is replaced; an existing ``path`` raises and an empty table writes no shard.
    """
    docs.withColumn("shard", shard_of(F.col(id_col), shards)).write.partitionBy("shard").parquet(path)
