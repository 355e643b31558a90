"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpointed, counted, fitted


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of the edges; the component is its smallest node.

    Alternating large-star and small-star steps: neighbours are never gathered into lists, each step is a
    minimum per node and a join back, and the number of rounds grows with the logarithm of the longest
    path. Loops, repeated edges and edges with a null end are allowed and add nothing. Raises if
    ``max_rounds`` is not enough.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    pairs, n = counted(pairs)
    seen = None
    for _ in range(max_rounds):
        # each step is held in as many tasks as its rows need
        fit = lambda df: fitted(df, 2 * n)  # noqa: E731, B023
        pairs = fit(pairs)
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = fit(fit(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = fit(large.join(low, "u")).select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")), F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("p"))
        made = fit(small.select(F.col("p.x").alias("u"), F.col("p.y").alias("v")).where("u != v").distinct())
        now = Observation()
        pairs = checkpointed(made.observe(now, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash")))
        n, state = now.get["n"], (now.get["n"], now.get["hash"])
        if state == seen:
            roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
