"""Small groups are compared without cells, large ones in the grid; both give all pairs."""

import pytest
from pyspark.sql import functions as F

from curatrix.operators import grid

from .test_grid import mixed, overlap, table


@pytest.mark.parametrize("direct", [0, 25, 64])
def test_pairs_do_not_depend_on_how_a_group_is_compared(spark, direct):
    rows, df = table(spark, mixed(4), frames=("f", "f", "f", "g", None), classes=("c", "k"), seed=3)
    found = grid.overlapping(df, df, ["frame", "class_id"], 0.1, direct_boxes=direct).where("a.pos < b.pos").select("a.pos", F.col("b.pos").alias("other"), "iou").collect()
    want = {(a[1], b[1]): overlap(a[4:], b[4:]) for a in rows for b in rows if a[1] < b[1] and (a[0], a[2]) == (b[0], b[2]) and overlap(a[4:], b[4:]) > 0.1}
    assert len(found) == len(want) and {(r.pos, r.other): pytest.approx(r.iou) for r in found} == want


def test_small_groups_are_not_dealt_into_cells(spark):
    _, df = table(spark, [(0, 0, 4, 4), (1, 1, 5, 5), (2, 2, 3, 9)])
    plan = grid.overlapping(df, df, ["frame", "class_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" not in plan and "Join" not in plan
