import hashlib
import re

import pytest

from curatrix.llm import mixing

from .conftest import EDGE_TEXTS


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target, free = float(sum(sizes.values())), dict.fromkeys(order, 0.0), set(order)
    while left > 1e-9 and free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if target[s] + share * weight[s] >= 3 * sizes[s]}
        if not over:
            for s in free:
                target[s] += share * weight[s]
            break
        for s in over:
            left -= 3 * sizes[s] - target[s]
            target[s] = 3.0 * sizes[s]
        free -= over
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_plan_matches_a_loop_over_documents(make_docs, words):
    texts = EDGE_TEXTS + [words(n % 37 + 1) for n in range(300)]
    sources = [["a", "b", None, "c", "d", "é"][min(5, k * k % 11)] for k in range(len(texts))]
    rows = mixing.curriculum_plan(make_docs(texts, sources)).collect()
    sizes = {}
    for t, s in zip(texts, sources):
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = brute_targets(sizes)
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows}
    for s in sizes:
        own = sorted((k + 1 for k in range(len(texts)) if sources[k] == s), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
        asked = int(targets[s] + 0.5 + 1e-9)
        whole, rest = divmod(asked, sizes[s]) if sizes[s] else (0, 0)
        for i in own:
            r, n = by_id[i], size(texts[i - 1])
            assert r["size"] == n and r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
            part = min(n, rest)
            rest -= part
            assert r.taken == whole * n + part <= 3 * n
            assert len(r.positions) == (whole + (part > 0) if n else 0) and all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        assert sum(by_id[i].taken for i in own) == asked


def test_schedules_place_sources_early_or_late(make_docs):
    texts = ["w " * 10] * 600
    sources = [("a", "b", "c")[k % 3] for k in range(600)]
    rows = mixing.curriculum_plan(make_docs(texts, sources)).collect()
    mean = {s: sum(p for r in rows if r.source == s for p in r.positions) / sum(len(r.positions) for r in rows if r.source == s) for s in "abc"}
    assert mean["a"] < mean["b"] < mean["c"]


def test_mixed_corpus_keeps_columns_and_repeats(make_docs, words):
    docs = make_docs([words(20) for _ in range(40)], ["a"] * 4 + ["b"] * 36)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    n = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(n[i] == 3 for i in (1, 2, 3, 4)) and max(n.values()) <= 3


def test_one_source_takes_everything_once(make_docs):
    rows = mixing.curriculum_plan(make_docs(["a b", "c", None])).collect()
    assert sorted(r.taken for r in rows) == [0, 1, 2]


def test_empty_table_and_no_words(make_docs):
    assert mixing.curriculum_plan(make_docs(["x"]).limit(0)).count() == 0
    assert [r.taken for r in mixing.curriculum_plan(make_docs([None, " "])).collect()] == [0, 0]
