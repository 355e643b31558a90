"""Exact and perceptual duplicates of images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashes import hamming
from ..session import counted, shuffled
from .components import connected_components

#: Fixed value: hashes that differ in this many bits or fewer are near duplicates.
NEAR_BITS = 4
#: With more bits bands are so short that a hash shares one with most others, and has it compared in several of them.
BAND_BITS = 8
#: Hashes of a block, and of those compared with a block at once.
BLOCK, AT_ONCE = 4096, 128


def first_of_each(rows: DataFrame, value: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows kept, rows dropped): of equal values the first in order stays; null values are equal. ``order`` must tell the
    rows of a value apart. A value's first is a minimum, however often it repeats."""
    first = rows.groupBy(F.col(value).alias("_value")).agg(F.min(F.struct(*order)).alias("_first"))
    marked = rows.join(first, F.col(value).eqNullSafe(F.col("_value"))).withColumn("_stays", F.struct(*order).eqNullSafe(F.col("_first")))
    return marked.where("_stays").select(*rows.columns), marked.where("not _stays").select(*rows.columns)


def hash_pairs(hashes: DataFrame, bits: int = NEAR_BITS) -> DataFrame:
    """(a, b, distance) for all pairs of distinct hashes a < b that differ in ``bits`` bits or fewer.

    ``hashes`` has one long column ``h``. Of two such hashes, cut into bits + 1 bands, one band is equal:
    an equality join per band finds them. The more bits are allowed, the shorter the bands; beyond
    ``BAND_BITS`` they select little, and every pair is compared once, block by block.
    """
    distinct = hashes.where("h is not null").select("h").distinct()
    if bits > BAND_BITS:
        return _compared(distinct, bits)
    bands = bits + 1
    edges = [64 * k // bands for k in range(bands + 1)]
    parts = [F.struct(F.lit(k).alias("band"), F.shiftrightunsigned("h", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 63 else -1)).alias("part")) for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))]
    keyed = distinct.select("h", F.inline(F.array(*parts)))
    left, right = keyed.select("band", "part", F.col("h").alias("a")), keyed.select("band", "part", F.col("h").alias("b"))
    near = left.join(right, ["band", "part"]).where("a < b").withColumn("distance", hamming(F.col("a"), F.col("b"))).where(F.col("distance") <= bits)
    return near.select("a", "b", "distance").distinct()


def _compared(distinct: DataFrame, bits: int) -> DataFrame:
    """``hash_pairs`` of unlike hashes by comparing all: blocks of them are dealt out, and each two blocks meet in one row."""
    distinct, n = counted(distinct)
    blocks = max(1, -(-n // BLOCK))
    packed = distinct.groupBy(F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int").alias("k")).agg(F.collect_list("h").alias("hs"))
    rows = packed.select(F.explode(F.sequence("k", F.lit(blocks - 1))).alias("j"), F.col("k").alias("i"), F.col("hs").alias("left"))
    columns = packed.select(F.explode(F.sequence(F.lit(0), "k")).alias("i"), F.col("k").alias("j"), F.col("hs").alias("right"))
    met = shuffled(rows).join(columns, ["i", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                left, right = (batch.column(c)[at].values.to_numpy(zero_copy_only=False) for c in ("left", "right"))
                same = batch.column("i")[at] == batch.column("j")[at]
                for start in range(0, len(left), AT_ONCE):
                    some = left[start : start + AT_ONCE]
                    distance = np.bitwise_count((some[:, None] ^ right[None, :]).view(np.uint64))
                    x, y = np.nonzero(distance <= bits)
                    a, b, d = some[x], right[y], distance[x, y].astype(np.int32)
                    # two places of one block meet twice
                    once = a < b if same else slice(None)
                    yield pa.record_batch([np.minimum(a, b)[once], np.maximum(a, b)[once], d[once]], ["a", "b", "distance"])

    return met.select("i", "j", "left", "right").mapInArrow(run, "a long, b long, distance int")


def duplicate_groups(items: DataFrame, bits: int = NEAR_BITS) -> DataFrame:
    """(id, group_id) of items (id, sha256, h): equal bytes, equal hashes and near hashes connect; a group is
    named after its smallest id.

    Items are linked to the first item of their bytes and of their hash, hashes to each other, so that
    a hash shared by any number of items adds one link an item.
    """
    by_bytes = items.groupBy("sha256").agg(F.min("id").alias("b"))
    by_hash = items.where("h is not null").groupBy("h").agg(F.min("id").alias("b"))
    names = by_hash.select("h", "b")
    near = hash_pairs(items.select("h"), bits).join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = items.join(by_bytes, "sha256").select(F.col("id").alias("a"), "b").unionByName(items.join(by_hash, "h").select(F.col("id").alias("a"), "b")).unionByName(near)
    parts = connected_components(links).select(F.col("node").alias("id"), "component")
    return items.select("id").distinct().join(parts, "id", "left").select("id", F.concat(F.lit("group-"), F.coalesce("component", "id")).alias("group_id"))
