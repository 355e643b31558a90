"""Perceptual hashes as 64-bit longs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def average_hash(thumbnail: Column) -> Column:
    """Bit i is set if value i of a 64-value thumbnail is at least the mean; null for other lengths."""
    values = F.transform(thumbnail, lambda v: v.cast("double"))
    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / 64
    bits = F.transform(values, lambda v, i: F.when(v >= mean, _bit(i)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(thumbnail) == 64, F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
