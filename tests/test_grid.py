import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.operators import grid, nms

SCHEMA = "frame string, pos int, class_id string, confidence double, x1 double, y1 double, x2 double, y2 double"


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    i = max(0.0, w) * max(0.0, h)
    u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i
    return i / u if u > 0 else 0.0


def table(spark, boxes, frames=("f",), classes=("c",), seed=0):
    rng = random.Random(seed)
    rows = [(rng.choice(frames), k, rng.choice(classes), rng.choice([0.3, 0.5, 0.9]), *map(float, b)) for k, b in enumerate(boxes)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def mixed(seed, n=120):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w, h = (rng.choice([0.3, 1, 2, 7.9, 8, 64, 200]) for _ in range(2))
        x, y = (rng.choice([-8, 0, 1, 3.5, 64, 100]) + rng.random() for _ in range(2))
        out.append((x, y, x + w, y + h))
    return out + [(5, 5, 5, 9), (0, 0, 8, 8), (0, 0, 8, 8), (8, 0, 16, 8), (9, 9, 3, 3)]


@pytest.mark.parametrize("least", [0.0, 0.2, 0.5, 0.9])
def test_pairs_against_all_pairs(spark, least):
    rows, df = table(spark, mixed(1), frames=("f", "g", None), classes=("c", "k"), seed=2)
    found = grid.overlapping(df, df, ["frame", "class_id"], least).where("a.pos < b.pos").select("a.pos", F.col("b.pos").alias("other"), "iou").collect()
    want = {(a[1], b[1]): overlap(a[4:], b[4:]) for a in rows for b in rows if a[1] < b[1] and (a[0], a[2]) == (b[0], b[2]) and overlap(a[4:], b[4:]) > least}
    assert len(found) == len(want)
    assert {(r.pos, r.other): pytest.approx(r.iou) for r in found} == want


def compared(df, least):
    rows = grid.in_cells(df, ["frame", "class_id"], least)
    return rows.groupBy("_cell").count().selectExpr("sum(count * (count - 1) / 2) AS n").first().n


def test_clustered_and_crossing_boxes_meet_few_others(spark):
    rng = random.Random(3)
    clusters = [(rng.randrange(40) * 100 + rng.random() * 20, rng.randrange(40) * 100 + rng.random() * 20) for _ in range(1500)]
    clustered = [(x, y, x + rng.choice([10, 20, 40]), y + rng.choice([10, 20, 40])) for x, y in clusters]
    crossing = [(0, y, 4000, y + 3) for y in range(0, 4000, 5)] + [(x, 0, x + 3, 4000) for x in range(0, 4000, 5)]
    for boxes in (clustered, crossing):
        _, df = table(spark, boxes)
        assert compared(df, 0.5) < 0.1 * len(boxes) * (len(boxes) - 1) / 2


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.5, 1.0])
def test_rounds_agree_with_the_fold(spark, threshold):
    _, df = table(spark, mixed(5), frames=("f", "g", None), classes=("c", "k"), seed=6)
    few = nms.suppress(df, "frame", 0.25, threshold)
    many = nms.suppress(df, "frame", 0.25, threshold, fold_boxes=0)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))


def test_small_frames_are_folded_and_large_ones_go_in_rounds(spark):
    rng = random.Random(7)
    boxes = [(k * 3 + rng.random(), 0, k * 3 + 10, 10) for k in range(60)]
    rows = [("large", k, "c", 0.5 + k % 7 / 20, *map(float, b)) for k, b in enumerate(boxes)] + [("small", k, "c", 0.5, *map(float, b)) for k, b in enumerate(boxes[:5])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(str, nms.suppress(df, "frame", fold_boxes=10).collect())) == sorted(map(str, nms.suppress(df, "frame").collect()))


def test_a_hot_frame_of_fifty_thousand_boxes(spark):
    """A third of them lie in one heap; the fold over the whole frame in numpy gives the same."""
    rng = np.random.default_rng(8)
    n = 50_000
    corner = rng.uniform(0, 12_000, (n, 2))
    corner[: n // 3] = 500 + rng.uniform(0, 2, (n // 3, 2))
    boxes = np.concatenate([corner, corner + rng.uniform(10, 40, (n, 2))], axis=1).round(3)
    boxes[: n // 3, 2:] = boxes[: n // 3, :2] + 30
    score = rng.integers(25, 100, n) / 100
    order = np.lexsort((np.arange(n), -score))
    live, want = np.ones(n, bool), set()
    area = (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])
    for k in order:
        if live[k]:
            want.add(int(k))
            w = np.maximum(0, np.minimum(boxes[:, 2], boxes[k, 2]) - np.maximum(boxes[:, 0], boxes[k, 0]))
            h = np.maximum(0, np.minimum(boxes[:, 3], boxes[k, 3]) - np.maximum(boxes[:, 1], boxes[k, 1]))
            live &= ~(w * h / (area + area[k] - w * h) > 0.5)
    rows = spark.createDataFrame([("f", k, "c", float(score[k]), *map(float, boxes[k])) for k in range(n)], SCHEMA)
    kept, rounds = nms.suppress_in_rounds(rows, "frame", 0.5)
    assert {r.pos for r in kept.select("pos").collect()} == want
    assert rounds < 60
