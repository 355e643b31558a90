import random

import numpy as np
import xxhash

from curatrix.llm import simhash
from curatrix.operators.components import connected_components

from .conftest import EDGE_TEXTS


def brute_print(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r " else c for c in words).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """Smallest key reachable over links of two bits, for {key: fingerprint}."""
    parent = {k: k for k in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def test_documents(make_docs, words):
    rng = random.Random(2)
    texts = EDGE_TEXTS + [words(n) for n in (1, 2, 3, 4, 30, 200)]
    for _ in range(60):
        base = words(300).split()
        for _ in range(4):
            copy = list(base)
            if rng.random() < 0.7:
                copy[rng.randrange(300)] = "edit"
            texts.append(" ".join(copy))
    rows = {r.doc_id: r for r in simhash.near_duplicates(make_docs(texts)).collect()}
    prints = {k + 1: brute_print(t) for k, t in enumerate(texts)}
    classes = brute_classes(prints)
    assert len(rows) == len(texts) and len(set(classes.values())) < len(texts)
    for k, r in rows.items():
        assert r.fingerprint == f"{prints[k]:016x}" and r.component_id == classes[k]


def planted(rng):
    centres = [rng.getrandbits(64) for _ in range(20)]
    out = {0, (1 << 64) - 1, 1 << 63}
    for c in centres:
        for _ in range(30):
            x = c
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def classes_of(spark, values, run_rows):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.hamming_links(spark.createDataFrame([(v,) for v in signed], "fp long"), run_rows=run_rows)
    parts = {r.node: r.component for r in connected_components(links).collect()}
    groups = {}
    for v, s in zip(values, signed):
        groups.setdefault(parts.get(s, s), set()).add(v)
    return sorted(map(sorted, groups.values()))


def test_links_are_exact_with_and_without_crowded_keys(spark):
    values = planted(random.Random(4))
    found = brute_classes({v: v for v in values})
    want = {}
    for v, c in found.items():
        want.setdefault(c, []).append(v)
    want = sorted(map(sorted, want.values()))
    assert classes_of(spark, values, simhash.RUN_ROWS) == want
    assert classes_of(spark, values, 3) == want


def test_every_pair_within_two_bits_shares_a_key(spark):
    rng = random.Random(8)
    pairs = []
    for n in (1, 2):
        for _ in range(60):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), n):
                b ^= 1 << bit
            pairs.append((a, b))
    values = sorted({x for p in pairs for x in p})
    groups = classes_of(spark, values, simhash.RUN_ROWS)
    assert all(any(a in g and b in g for g in groups) for a, b in pairs)


def test_near_links_links_each_to_the_smallest():
    prints = np.array(sorted([0, 1, 3, 7, 15, 1 << 40, 0xFFFF]), np.uint64)
    ends, roots = simhash.near_links(prints, 2)
    assert dict(zip(ends.tolist(), roots.tolist())) == {1: 0, 3: 0, 7: 0, 15: 0, 1 << 40: 0}


def test_one_of_each_group_stays(make_docs, words):
    a, b = words(50), words(50)
    docs = make_docs([a, b, a, None, "", b], ids=[5, 3, 2, None, None, 3])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3]


def test_null_and_repeated_ids_over_different_texts(make_docs, words):
    a, b, c, d = (words(50) for _ in range(4))
    # a under an id and under null; b under null only; c and d under one id, d under another too
    docs = make_docs([a, a, b, b, c, d, d], ids=[1, None, None, None, 7, 7, 9])
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == sorted([(1, a), (0, b), (7, c), (7, d)])


def test_empty_table(make_docs):
    docs = make_docs(["x"]).limit(0)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.drop_near_duplicates(docs).count() == 0
