"""Deterministic grouped splits that keep every class in the training split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import stable_order_key


#: Hexadecimal digits of the order's hash that make a chunk; running counts go by chunk, 4096 of them at most.
CHUNK_DIGITS = 3


def assign_splits(groups: DataFrame, classes: DataFrame, scope: str, seed: int = 42, train_fraction: float = 0.8, least_groups: int = 2) -> DataFrame:
    """(group_id, split): ``groups`` has group_id, ``classes`` the pairs (group_id, class_id) of its objects.

    Groups stand in a hash order of scope and seed. The first group of each class trains. More
    groups train in order until their number is the rounded share (at least the covered ones, at
    most all but one); the rest validate. If none is left, the last training group whose classes all have
    another one validates, else the last group. Fewer than ``least_groups``, or a share outside 0 to 1, raises; no groups
    give no rows. A lone group that is let through validates. Only sums of chunks of the order, not the groups, are put in order in one task.
    """
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("the share of training groups lies between 0 and 1, both excluded")
    names = groups.select("group_id").distinct().withColumn("key", stable_order_key(scope, seed, F.col("group_id")))
    names = names.select("group_id", F.struct("key", "group_id").alias("place"), F.substring("key", 1, CHUNK_DIGITS).alias("chunk"))
    pairs = classes.select("group_id", "class_id").distinct().join(names, "group_id")
    covering = pairs.groupBy("class_id").agg(F.min("place").alias("first")).select("first.group_id").distinct().withColumn("covers", F.lit(True))
    state = names.join(covering, "group_id", "left").withColumn("covers", F.coalesce("covers", F.lit(False)))
    # groups of its classes that a group may leave, counted a class; asked only where every group covers one
    counts = pairs.groupBy("class_id").agg(F.count("*").alias("n"))
    spare = pairs.join(counts.withColumnRenamed("class_id", "other"), F.col("class_id").eqNullSafe(F.col("other")))
    spare = spare.groupBy("group_id").agg(F.min(F.col("n") > 1).alias("spare"))
    state = state.join(spare, "group_id", "left").withColumn("spare", F.coalesce("spare", F.lit(True)))
    free = F.when(F.col("covers"), 0).otherwise(1)
    chunks = state.groupBy("chunk").agg(F.count("*").alias("n"), F.sum(free).alias("free"), F.max("place").alias("last"), F.max(F.when(F.col("spare"), F.col("place"))).alias("last_spare"))
    everything = Window.partitionBy()
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    n, all_free = F.sum("n").over(everything), F.sum("free").over(everything)
    moved = F.coalesce(F.max("last_spare").over(everything), F.max("last").over(everything))
    chunks = chunks.select("chunk", n.alias("n"), (n - all_free).alias("covered"), F.coalesce(F.sum("free").over(before), F.lit(0)).alias("offset"), moved.alias("moved"))
    inside = Window.partitionBy("chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    ranked = state.withColumn("free_rank", F.sum(free).over(inside)).join(chunks, "chunk")
    target = F.greatest("covered", F.least(F.col("n") - 1, F.bround(F.col("n") * F.lit(train_fraction)).cast("long")))
    checked = F.when(F.col("n") >= least_groups, F.lit(True)).otherwise(F.raise_error(F.lit("at least two groups are needed")).cast("boolean"))
    trains = F.col("covers") | (F.col("offset") + F.col("free_rank") <= target - F.col("covered"))
    # nothing is left to validate just if every group covers a class
    last_resort = (F.col("covered") == F.col("n")) & (F.col("place") == F.col("moved"))
    return ranked.select("group_id", F.when(checked & trains & ~last_resort, "train").otherwise("validation").alias("split"))
