import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.functions import geometry as g
from curatrix.functions.geometry import Box


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def box(*sides):
    return Box(*(F.lit(float(s)) for s in sides))


def lits(*values):
    return [F.lit(float(v)) for v in values]


def test_inverse_stretch_values(spark):
    back = lambda *b: g.inverse_stretch(box(*b), *lits(64, 64, 100, 80))
    assert one(spark, back(-10, -10, 100, 100)) == [0, 0, 100, 80]
    assert one(spark, back(64, 0, 70, 5)) is None
    assert one(spark, back(6.4, 8, 19.2, 24)) == pytest.approx([10, 10, 30, 30])
    for bad in ((10, 0, 5, 1), (0, 0, math.inf, 1), (math.nan, 0, 1, 1)):
        with pytest.raises(Exception, match="invalid tensor box"):
            one(spark, back(*bad))


@pytest.mark.parametrize(
    ("sides", "rules"),
    [((0, 0, 10, 10), []), ((5, 0, 5, 10), ["box_inverted"]), ((-1, 0, 5, 10), ["box_out_of_bounds"]), ((20, 0, 12, 10), ["box_inverted", "box_out_of_bounds"]), ((math.nan, 0, 1, 1), ["box_shape"]), ((0, 0, math.inf, 1), ["box_shape"])],
)
def test_box_rules(spark, sides, rules):
    assert one(spark, g.box_rules(box(*sides), *lits(10, 10))) == rules


def test_box_rules_of_short_arrays_and_without_a_frame(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 3.0],), (None,), ([0.0, 0.0, 9e9, 9e9],)], "b array<double>")
    null = F.lit(None).cast("double")
    assert [r.x for r in rows.select(g.box_rules(Box.of(F.col("b")), null, null).alias("x")).collect()] == [["box_shape"], ["box_shape"], []]


def test_representable(spark):
    take = lambda x, y, w, h: one(spark, g.representable(*lits(x, y, w, h, 1, 40, 30)))
    assert take(1, 2, 3, 4) == [1, 2, 4, 6]
    assert take(-0.5, 0, 10, 30.5) == [0, 0, 9.5, 30]
    assert take(-0.6, 0, 10, 10) is None and take(1, 1, 0, 5) is None and take(1, 1, math.nan, 5) is None
    # no area is judged before clipping
    assert take(40, 1, 0.4, 5) == [40, 1, 40, 6]


def test_downscale_rounds_halves_to_even_and_never_grows(spark):
    rows = spark.createDataFrame([(2000, 5), (100, 50), (4000, 1), (1280, 1)], "w int, h int")
    scale, w, h = g.downscaled(F.col("w"), F.col("h"), 1000)
    assert [(r.w2, r.h2) for r in rows.select(w.alias("w2"), h.alias("h2")).collect()] == [(1000, 2), (100, 50), (1000, 1), (1000, 1)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(*[st.floats(0, 50)] * 4), min_size=1, max_size=6))
def test_iou_bounds(spark, corners):
    rows = spark.createDataFrame([(min(a, c), min(b, d), max(a, c) + 1, max(b, d) + 1) for a, b, c, d in corners], "x1 double, y1 double, x2 double, y2 double")
    shifted = Box(F.col("x1") + 1, F.col("y1"), F.col("x2") + 1, F.col("y2"))
    r = rows.select(g.iou(Box.named(), Box.named()).alias("same"), g.iou(Box.named(), shifted).alias("a"), g.iou(shifted, Box.named()).alias("b")).collect()
    assert all(x.same == pytest.approx(1) and 0 <= x.a <= 1 and x.a == pytest.approx(x.b) for x in r)


def test_iou_without_area_is_zero(spark):
    assert one(spark, g.iou(box(1, 1, 1, 1), box(1, 1, 1, 1))) == 0


def test_normalised_and_letterbox(spark):
    shares = g.normalised(box(10, 20, 30, 60), *lits(100, 80))
    assert [one(spark, s) for s in shares] == pytest.approx([0.2, 0.5, 0.2, 0.5])
    assert one(spark, g.inverse_letterbox(box(10, 20, 30, 40), *lits(0, 10, 2, 50, 8))) == [5, 5, 15, 8]
    assert one(spark, g.inverse_letterbox(box(-9, 20, -1, 40), *lits(0, 10, 2, 50, 8))) is None
