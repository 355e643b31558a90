import math
import random

import numpy as np
import pytest

from curatrix.llm import hard_negatives as h


def brute(rows, mod=10, scale=256, k_pos=5, k_neg=5):
    good = [
        (at, i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for at, (i, label, v) in enumerate(rows)
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, anchor, label, own in good:
        if anchor % mod:
            continue
        scored = [(-sum(a * b for a, b in zip(own, v)), i, other) for k, i, other, v in good if k != at]
        positives = sorted((s, i) for s, i, other in scored if other == label)[:k_pos]
        for p_score, positive in positives:
            fits = sorted((s, i) for s, i, other in scored if other != label and 80 * -p_score <= 100 * -s <= 100 * -p_score)[:k_neg]
            out += [(anchor, positive, r + 1, i, -p_score, -s) for r, (s, i) in enumerate(fits)]
    return sorted(out)


def run(spark, rows, mod=10, **how):
    df = spark.createDataFrame([(i, label, v, "x", "y") for i, label, v in rows], "vec_id long, label int, embedding array<float>, row string, lane string")
    return sorted(tuple(r) for r in h.mine_hard_negatives(df, query_mod=mod, **how).collect())


def small(monkeypatch):
    for name, value in (("LEAST_LANE_ROWS", 40), ("LANES", 6), ("LEAST_GROUP_ROWS", 8), ("ANCHOR_LEAF", 2), ("LEAF", 4)):
        monkeypatch.setattr(h, name, value)


def clustered(seed, n=240, labels=4, noise=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(labels + 2)]
    return [(i, rng.randrange(labels), [c + rng.gauss(0, noise) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_against_all_products(spark, monkeypatch, seed):
    small(monkeypatch)
    rows = clustered(seed)
    counted = spark.sparkContext.accumulator(0)
    assert run(spark, rows, counted=counted) == brute(rows)


def test_a_hot_vector_and_label_ties_twins_and_unusable_rows(spark, monkeypatch):
    small(monkeypatch)
    hot = [(i, 0, [1.0, 0.5, 0.0]) for i in range(60)] + [(i, 1, [1.0, 0.5, 0.0]) for i in range(200, 230)]
    twins = [(300, 2, [0.5, 0.5, 0.1]), (300, 2, [0.5, 0.5, 0.1]), (301, 2, [0.4, 0.5, 0.1]), (310, 3, [-1.0, 0.2, 0.3]), (311, 3, [1.0, 0.0, 0.0])]
    odd = [(320, None, [1.0]), (None, 1, [1.0]), (330, 1, None), (340, 1, [None]), (350, 1, [float("nan")]), (360, 1, [float("inf"), 1.0]), (370, 5, [1.0, 1.0, 1.0]), (380, 2, [0.6]), (390, 2, [])]
    rows = hot + twins + odd
    assert run(spark, rows) == brute(rows)


def test_no_rows_and_nothing_usable(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, None, [1.0])]) == []
    assert run(spark, [(0, 1, [1.0])]) == []


def test_products_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="over 64 bits"):
        run(spark, [(0, 1, [1e13]), (1, 1, [1e13])])


def test_far_groups_are_left_out_at_once(monkeypatch):
    monkeypatch.setattr(h, "ANCHOR_LEAF", 4)
    monkeypatch.setattr(h, "LEAF", 16)
    rng = np.random.default_rng(4)
    centres = np.eye(4) * 400
    place = rng.integers(0, 4, 400)
    rows = {"v": (centres[place] + rng.normal(0, 5, (400, 4))).astype(np.int64), "label": np.zeros(400, np.int64), "row": np.arange(400), "id": np.arange(400)}
    anchors = {k: v[:64] for k, v in rows.items()}
    found, products = h.find_positives(anchors, rows, 5, np.full(64, h.LEAST))
    scores = anchors["v"] @ rows["v"].T
    assert products < scores.size / 2
    for at in range(64):
        others = [j for j in range(400) if j != at]
        assert found[at].ids.tolist() == sorted(others, key=lambda j: (-scores[at, j], j))[:5]


def test_relabelled_rows(spark):
    df = spark.createDataFrame([(7, 9, [1.0]), (8, 9, [1.0]), (14, None, [1.0])], "vec_id long, label int, embedding array<float>")
    assert [r.label for r in h.contract_labels(df).orderBy("vec_id").collect()] == [0, 9, None]
