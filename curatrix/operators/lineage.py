"""Lineage: runs as edges to hashed artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_sets(edges: DataFrame, keys: list[str], value: str = "sha256") -> DataFrame:
    """Per key the sorted set of values as ``hashes``. Sets are those of one run: a few artifacts."""
    return edges.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("hashes"))


def same_keys(a: Column, b: Column) -> Column:
    """Whether two maps have the same keys."""
    return F.array_sort(F.map_keys(a)) == F.array_sort(F.map_keys(b))


def missing_from(required: list[str], present: Column) -> Column:
    """Which of the required names an array lacks."""
    return F.array_except(F.array(*map(F.lit, required)), present)


def unequal_sets(edges: DataFrame, run: str, side: str = "side", value: str = "sha256") -> DataFrame:
    """Runs whose input and output sets differ: (run, n_inputs, n_outputs)."""
    sets = edges.groupBy(run).agg(*(F.array_sort(F.collect_set(F.when(F.col(side) == s, F.col(value)))).alias(s) for s in ("inputs", "outputs")))
    return sets.where(F.col("inputs") != F.col("outputs")).select(run, F.size("inputs").cast("long").alias("n_inputs"), F.size("outputs").cast("long").alias("n_outputs"))


def best_row(rows: DataFrame, group: list[str], metric: str, pos: list[str]) -> DataFrame:
    """The row with the greatest metric of each group; a missing metric is least, the first of equal rows wins."""
    from pyspark.sql import Window

    order = Window.partitionBy(*group).orderBy(F.desc_nulls_last(metric), *pos)
    return rows.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")
