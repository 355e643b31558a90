"""Overlapping boxes by cells of grids, in groups of any size.

A box has a level in each direction, the power of two below its side. It registers in the cells it touches of the grid
of its own level and of coarser ones; there it is never wider than a cell and touches four at most. Two boxes meet in the
grid of the greater level of each direction, in the cell that holds the upper left corner of what they share, and
nowhere else. Boxes whose overlap is over t differ in a side by a factor below 1/t, which bounds the
levels: grids of far coarser boxes are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box, iou
from ..session import checkpointed

#: Boxes of both sides of a group that are compared without cells at most.
DIRECT_BOXES = 64
SIDES = ("x1", "y1", "x2", "y2")


def _level(side: Column) -> Column:
    """The whole number k with 2**k <= side < 2**(k + 1); a logarithm may be off by one."""
    near = F.floor(F.log2(side))
    return F.when(F.pow(F.lit(2.0), near) > side, near - 1).when(F.pow(F.lit(2.0), near + 1) <= side, near + 1).otherwise(near).cast("int")


def _cells(low: Column, high: Column, level: Column) -> Column:
    side = F.pow(F.lit(2.0), level + 1)
    return F.sequence(F.floor(low / side), F.floor(high / side))


def in_cells(boxes: DataFrame, keys: list[str], least_iou: float = 0.0) -> DataFrame:
    """``boxes`` (keys, x1, y1, x2, y2 and others), a row for each cell, with _cell (level and place in both directions) and
    _cells, how many the box has. Boxes without an area overlap nothing and are left out."""
    flat = boxes.where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    flat = flat.withColumns({"_w": _level(F.col("x2") - F.col("x1")), "_h": _level(F.col("y2") - F.col("y1"))})
    most = flat.groupBy(*keys).agg(F.max("_w").alias("_most_w"), F.max("_h").alias("_most_h"))
    held = flat.join(most.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_most_w", "_most_h"), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    up = 2_000 if least_iou <= 0 else math.ceil(math.log2(1 / least_iou) + 1e-9)
    levels = lambda own, top: F.sequence(F.col(own), F.least(F.col(own) + up, F.col(top)))
    places = F.flatten(F.transform(levels("_w", "_most_w"), lambda w: F.flatten(F.transform(levels("_h", "_most_h"), lambda h: F.flatten(F.transform(
        _cells(F.col("x1"), F.col("x2"), w), lambda x: F.transform(_cells(F.col("y1"), F.col("y2"), h), lambda y: F.struct(w.alias("w"), h.alias("h"), x.alias("x"), y.alias("y")))))))))
    return held.withColumn("_places", places).select(*boxes.columns, F.size("_places").alias("_cells"), F.explode("_places").alias("_cell"))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], least_iou: float = 0.0, direct_boxes: int = DIRECT_BOXES) -> DataFrame:
    """(keys, a, b, iou): the pairs of a box of ``left`` and one of ``right``, as structs of their columns, that have the
    same keys and an overlap over ``least_iou``. Null keys are equal. Each pair is found once.

    Groups of up to ``direct_boxes`` are compared as they are, in one shuffle. In larger ones only boxes of one cell are
    compared; a place where many boxes lie on each other gives the pairs that there are.
    """
    both = left.select(*keys, *SIDES, F.struct(*left.columns).alias("a"), F.lit(True).alias("_left")).unionByName(
        right.select(*keys, *SIDES, F.struct(*right.columns).alias("b"), F.lit(False).alias("_left")), allowMissingColumns=True)
    both = both.where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    large = checkpointed(both.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > direct_boxes).select(*(F.col(k).alias(f"_l{i}") for i, k in enumerate(keys))))
    if large.isEmpty():
        return _in_groups(both, keys, least_iou)
    same = [F.col(k).eqNullSafe(F.col(f"_l{i}")) for i, k in enumerate(keys)]
    return _in_groups(both.join(large, same, "left_anti"), keys, least_iou).unionByName(_in_grids(both.join(large, same, "left_semi"), keys, least_iou))


def _in_groups(both: DataFrame, keys: list[str], least_iou: float) -> DataFrame:
    """Every box of the left side with all of the right in its group, whose boxes are few."""
    met = both.withColumn("_others", F.collect_list("b").over(Window.partitionBy(*keys))).where("_left").select(*keys, "a", F.explode("_others").alias("b"))
    boxes = [Box(*(F.col(f"{s}.{c}") for c in SIDES)) for s in "ab"]
    return met.select(*keys, "a", "b", iou(*boxes).alias("iou")).where(F.col("iou") > least_iou)


def _in_grids(both: DataFrame, keys: list[str], least_iou: float) -> DataFrame:
    # both sides share the levels of their group
    rows = in_cells(both, keys, least_iou)
    own, other = rows.where("_left").select(*keys, "_cell", "a"), rows.where("not _left").select(*(F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)), F.col("_cell").alias("_other"), "b")
    met = own.join(other, [F.col("_cell") == F.col("_other"), *(F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys))])
    greater = lambda lo, hi: F.greatest(*(_level(F.col(f"{s}.{hi}") - F.col(f"{s}.{lo}")) for s in "ab"))
    corner = lambda side, level: F.floor(F.greatest(F.col(f"a.{side}"), F.col(f"b.{side}")) / F.pow(F.lit(2.0), F.col(f"_cell.{level}") + 1))
    here = (F.col("_cell.w") == greater("x1", "x2")) & (F.col("_cell.h") == greater("y1", "y2")) & (F.col("_cell.x") == corner("x1", "w")) & (F.col("_cell.y") == corner("y1", "h"))
    boxes = [Box(*(F.col(f"{s}.{c}") for c in SIDES)) for s in "ab"]
    return met.where(here).select(*keys, "a", "b", iou(*boxes).alias("iou")).where(F.col("iou") > least_iou)
