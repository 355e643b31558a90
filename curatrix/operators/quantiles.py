"""Exact quantiles of groups of any size.

A rank is looked for in an open range of values, at first all. Approximate quantiles cut the range; how many rows lie
between two cuts and on each cut is counted exactly, so the counts alone decide where the rank is, and the
sketch decides only how evenly the range is cut. A rank on a cut is found; another one goes on in the range between two
cuts, until it holds few rows. These are counted by value and summed up in order. No task sees a group whole, and all
counts are summed before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, counted

#: Cuts of a range in a round, and rows of a range that are put in order at last.
CUTS, MOST_ROWS = 64, 50_000
#: Ranges that are broadcast to the values at most; the values are shuffled by group to more of them.
MAX_BROADCAST_RANGES = 10_000


def ranked_values(rows: DataFrame, keys: list[str], value: str, ranks: DataFrame, cuts: int = CUTS, most_rows: int = MOST_ROWS) -> DataFrame:
    """(keys, rank, value): the value of each rank of ``ranks`` (keys, rank from 1) among the non-null values of its group in
    rising order; ranks beyond a group give no row. Null keys are a group. Values must not be NaN.
    """
    names = [f"_k{i}" for i in range(max(1, len(keys)))]
    of = lambda: [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)] if keys else [F.lit(0).alias(names[0])]
    source = rows.where(F.col(value).isNotNull()).select(*of(), F.col(value).cast("double").alias("_v"))
    own = [*names, "_rank", "_left", "_low", "_high"]
    # few ranges go to the values: a shuffle by group leaves all values to as many tasks as there are groups, in every round
    ranges, n_ranges = counted(ranks.select(*of(), F.col("rank").cast("long").alias("_rank")).distinct().select(
        *names, "_rank", F.col("_rank").alias("_left"), F.lit(None).cast("double").alias("_low"), F.lit(None).cast("double").alias("_high")))
    done = []

    def inside(bounds: DataFrame) -> DataFrame:
        """The values in each range, with all of the range's columns."""
        named = bounds.withColumnsRenamed({n: f"{n}o" for n in names})
        # there are never more ranges than ranks
        named = F.broadcast(named) if n_ranges <= MAX_BROADCAST_RANGES else named
        met = source.join(named, [F.col(n).eqNullSafe(F.col(f"{n}o")) for n in names])
        return met.where("(_low is null or _v > _low) and (_high is null or _v < _high)").drop(*(f"{n}o" for n in names))

    while True:
        sized = checkpointed(inside(ranges).groupBy(*own).agg(F.count("*").alias("_n")).where("_left <= _n"))
        wide = sized.where(F.col("_n") > most_rows)
        if wide.isEmpty():
            break
        shares = F.array(*(F.lit(k / (cuts + 1)) for k in range(1, cuts + 1)))
        cut = checkpointed(inside(wide.select(*own)).groupBy(*own).agg(F.array_distinct(F.percentile_approx("_v", shares, F.lit(100 * cuts))).alias("_cuts")))
        below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
        # even places lie between cuts, odd ones on them
        place = 2 * below + F.array_contains("_cuts", F.col("_v")).cast("int")
        counts = inside(cut).groupBy(*own, "_cuts", place.alias("_place")).agg(F.count("*").alias("_m"))
        upto = counts.withColumn("_upto", F.sum("_m").over(Window.partitionBy(*names, "_rank").orderBy("_place")))
        hit = checkpointed(upto.where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_m") < F.col("_left"))))
        at = (F.col("_place") / 2).cast("int")
        done.append(hit.where("_place % 2 = 1").select(*names, "_rank", F.get("_cuts", at).alias("_v")))
        moved = hit.where("_place % 2 = 0").select(
            *names, "_rank", (F.col("_left") - (F.col("_upto") - F.col("_m"))).alias("_left"),
            F.coalesce(F.get("_cuts", at - 1), "_low").alias("_low"), F.coalesce(F.get("_cuts", at), "_high").alias("_high"))
        ranges = checkpointed(sized.where(F.col("_n") <= most_rows).select(*own).unionByName(moved))
    last = inside(sized.select(*own)).groupBy(*own, "_v").agg(F.count("*").alias("_m"))
    upto = last.withColumn("_upto", F.sum("_m").over(Window.partitionBy(*names, "_rank").orderBy("_v")))
    found = upto.where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_m") < F.col("_left"))).select(*names, "_rank", "_v")
    for part in done:
        found = found.unionByName(part)
    return found.select(*(F.col(n).alias(k) for k, n in zip(keys, names, strict=False)), F.col("_rank").alias("rank"), F.col("_v").alias("value"))


def medians(rows: DataFrame, keys: list[str], values: list[str], **how: int) -> DataFrame:
    """(keys, values): the exact median of each of ``values`` in each group of ``keys`` (at least one), the mean of the middle
    two where they are two; null for groups without a value."""
    counts = checkpointed(rows.groupBy(*keys).agg(*(F.count(v).alias(v) for v in values)))
    out = counts.select(*keys)
    for value in values:
        n = F.col(value)
        middle = F.array_distinct(F.array(F.floor((n + 1) / 2), F.floor((n + 2) / 2)))
        ranks = counts.where(n > 0).select(*keys, F.explode(middle).alias("rank"))
        found = ranked_values(rows, keys, value, ranks, **how).groupBy(*keys).agg(F.avg("value").alias(value))
        named = found.withColumnsRenamed({k: f"_m{i}" for i, k in enumerate(keys)})
        same = [F.col(k).eqNullSafe(F.col(f"_m{i}")) for i, k in enumerate(keys)]
        out = out.join(named, same, "left").drop(*(f"_m{i}" for i in range(len(keys))))
    return out
