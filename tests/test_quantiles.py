import random
import statistics

import pytest

from curatrix.operators import quantiles


def groups(seed):
    rng = random.Random(seed)
    rows = [("hot", rng.gauss(0, 10 ** rng.randrange(-8, 9))) for _ in range(3_000)]
    rows += [("ties", 5.0)] * 1_500 + [("ties", 1.0)] * 700 + [("ties", 7.5)] * 799
    rows += [("few", v) for v in (3.0, -1.0, None, 2.0)] + [("one", 4.0), ("none", None), (None, 1.0), (None, 2.0)]
    rows += [("big", float(k % 997)) for k in range(4_000)] + [("edge", v) for v in (float("inf"), float("-inf"), 0.0, -0.0, 1e-308)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"cuts": 4, "most_rows": 20}, {"cuts": 1, "most_rows": 1}])
def test_medians_against_a_plain_sort(spark, how):
    rows = groups(1) if how.get("cuts") != 1 else [r for r in groups(1) if r[0] in ("few", "one", "none", None, "edge")] + [("big", float(k % 7)) for k in range(50)]
    df = spark.createDataFrame(rows, "k string, v double").selectExpr("k", "v", "-v AS w")
    found = {r.k: (r.v, r.w) for r in quantiles.medians(df, ["k"], ["v", "w"], **how).collect()}
    want = {}
    for key in {k for k, _ in rows}:
        own = [v for k, v in rows if k == key and v is not None]
        want[key] = statistics.median(own) if own else None
    assert {k: v for k, (v, _) in found.items()} == want
    assert {k: None if w is None else -w for k, (_, w) in found.items()} == want


def test_any_ranks_of_one_hot_group(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.random(), 0.5, rng.randrange(5)]) for _ in range(2_000)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    asked = [1, 2, 1_000, 1_001, 1_999, 2_000, 2_001]
    found = quantiles.ranked_values(df, [], "v", spark.createDataFrame([(k,) for k in asked], "rank long"), cuts=8, most_rows=50)
    assert {r["rank"]: r.value for r in found.collect()} == {k: sorted(values)[k - 1] for k in asked if k <= len(values)}
