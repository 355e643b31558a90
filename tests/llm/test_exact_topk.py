import math
import random

import numpy as np
import pytest

from curatrix.llm import exact_topk


def brute(rows, k, mod, scale):
    good = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, own) in enumerate(good):
        if q % mod:
            continue
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for other, (i, v) in enumerate(good) if other != at)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=10, mod=10, scale=1024):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    return sorted(tuple(r) for r in exact_topk.top_k(df, k, query_mod=mod, scale=scale).collect())


def test_unequal_lengths_of_vectors_prune_and_stay_exact(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(exact_topk, "BUCKET_ROWS", 16)
    rows = [(i, [rng.gauss(0, 1) * math.exp(rng.gauss(0, 1.5)) for _ in range(8)]) for i in range(300)]
    assert run(spark, rows) == brute(rows, 10, 10, 1024)


@pytest.mark.parametrize("most", [3, 4096])
def test_lanes_that_grow_with_the_buckets_lose_nothing(spark, monkeypatch, most):
    rng = random.Random(2)
    for name, value in (("BUCKET_ROWS", 16), ("LANES", 1), ("LANE_BUCKETS", 2), ("MOST_LANES", most)):
        monkeypatch.setattr(exact_topk, name, value)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    assert run(spark, rows) == brute(rows, 10, 10, 1024)


def test_ties_copies_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, None), (101, [None, 1.0]), (102, [float("nan"), 1.0]), (110, [float("inf"), 0.0]), (None, [1.0, 1.0]), (40, [-0.5, 0.25]), (50, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows, 10, 10, 1024)


def test_twins_of_a_query_are_candidates(spark):
    v, w = [0.5, 1.0], [0.25, 0.0]
    found = run(spark, [(0, v), (0, v), (1, w)])
    assert found == brute([(0, v), (0, v), (1, w)], 10, 10, 1024)
    assert [r[:3] for r in found] == [(0, 1, 0), (0, 1, 0), (0, 2, 1), (0, 2, 1)]


def test_few_candidates_and_shorter_vectors(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [1.0]), (2, [])]) == [(0, 1, 1, 1024 * 1024), (0, 2, 2, 0)]
    assert run(spark, [(0, [1.0])]) == []
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(df).count() == 0


@pytest.mark.parametrize("top", [1.0, 30.0, 1e5])
def test_bucket_search_agrees_with_all_products(top):
    rng = np.random.default_rng(3)
    bucket = np.floor(rng.normal(size=(200, 16)) * np.geomspace(top * 50, 50, 200)[:, None]).astype(np.int64)
    bucket = bucket[np.argsort(-np.linalg.norm(bucket, axis=1), kind="stable")]
    ids = np.arange(200)
    queries = np.concatenate([bucket[:5] + 1, np.floor(rng.normal(size=(20, 16)) * 100).astype(np.int64)])
    scores = queries @ bucket.T
    bounds = np.sort(scores, 1)[:, -10].astype(float)
    found = {at: (s.tolist(), i.tolist()) for at, s, i in exact_topk.search_bucket(queries, np.full(25, -1), bounds, bucket, ids, ids, 10)}
    for at in range(25):
        order = np.lexsort((ids, -scores[at]))[:10]
        assert found[at] == (scores[at][order].tolist(), ids[order].tolist())
