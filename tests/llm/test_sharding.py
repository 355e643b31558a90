import zlib
from collections import Counter

import numpy as np

from curatrix.llm import sharding

from .conftest import EDGE_TEXTS


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_matches_the_published_loop():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump_buckets(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_documents(make_docs):
    texts = EDGE_TEXTS + [f"t{k}" for k in range(500)]
    ids = [None, -5, *range(len(texts) - 3), 7]
    rows = sharding.assign_shards(make_docs(texts, ids=ids)).collect()
    assert len(rows) == len(texts)
    by_id = dict(zip(ids, texts))
    for r in rows:
        key = int(sharding.mixed_keys(np.array([r.doc_id or 0], np.int64))[0])
        assert r.shard == jump(key, 8) and r.grown_shard == jump(key, 9) and r.grown_shard in (r.shard, 8)
        if r.doc_id != 7:
            raw = (by_id[r.doc_id] or "").encode()
            assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert {r.law for r in rows} == {"key"}


def test_empty_and_written(make_docs, spark, tmp_path):
    docs = make_docs(["a", "b", "c"])
    assert sharding.assign_shards(docs.limit(0)).count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 3 and "shard" in back.columns
