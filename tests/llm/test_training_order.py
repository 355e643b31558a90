import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from curatrix.llm import training_order as order
from curatrix.llm.queries import PATTERN

from .conftest import EDGE_TEXTS

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
ENCODING = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_keyed_permutation(n):
    a, b = (order.feistel(np.arange(n), n, seed) for seed in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 64 or (a != b).any()


def plain_feistel(x, n, seed):
    """The same network for one number, in Python's integers."""

    def mixed(v):
        v = (v + 0x9E3779B97F4A7C15) % (1 << 64)
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        v = (v ^ v >> 27) * 0x94D049BB133111EB % (1 << 64)
        return v ^ v >> 31

    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    while True:
        left, right = x >> half, x % (1 << half)
        for k in range(6):
            left, right = right, left ^ mixed(right ^ mixed(seed * 6 + k)) % (1 << half)
        x = left << half | right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1025])
def test_feistel_against_one_number_at_a_time(n):
    assert order.feistel(np.arange(n), n, 5).tolist() == [plain_feistel(x, n, 5) for x in range(n)]


def test_order_leaves_no_trace_of_the_index():
    slots = order.feistel(np.arange(20_000), 20_000, 7)
    assert abs(np.corrcoef(np.arange(20_000), slots)[0, 1]) < 0.03


def expected(texts, sequence):
    out = {}
    for k, t in enumerate(texts):
        ids = ENCODING.encode_ordinary(t or "")
        for p in range(-(-len(ids) // sequence)):
            out[k + 1, p] = ids[p * sequence : (p + 1) * sequence]
    return out


def test_documents_written_and_read_again(spark, make_docs, tmp_path):
    texts = EDGE_TEXTS + [f"text {k} " * (k % 90) for k in range(200)]
    records = order.token_records(make_docs(texts).repartition(5), FILE, PATTERN, sequence=16)
    ordered = order.training_order(records, seed=3, shard_records=50)
    want = expected(texts, 16)
    rows = ordered.collect()
    assert sorted(r.slot for r in rows) == list(range(len(want)))
    assert all(r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * (order.stride(16) + 1) and len(r.record) == order.stride(16) for r in rows)
    path = str(tmp_path / "shards")
    order.write_shards(ordered, path)
    back = order.read_slots(spark, path, 0, len(want), 16, 50).collect()
    assert {(r.doc_id, r.part): list(r.tokens) for r in back} == want
    assert {r.slot: (r.doc_id, r.part) for r in back} == {r.slot: (r.doc_id, r.part) for r in rows}
    some = order.read_slots(spark, path, 37, 120, 16, 50).collect()
    assert sorted(r.slot for r in some) == list(range(37, 120))


def test_null_ids_and_empty_tables(make_docs, spark):
    docs = make_docs(["some text", ""], ids=[None, 4])
    rows = order.training_order(order.token_records(docs, FILE, PATTERN)).collect()
    assert [(r.slot, r.doc_id) for r in rows] == [(0, None)]
    assert order.training_order(order.token_records(docs.limit(0), FILE, PATTERN)).count() == 0


def slots(records, **options):
    return {(r.doc_id, r.part, bytes(r.record), r.slot) for r in order.training_order(records, **options).collect()}


def test_slots_do_not_depend_on_partitions_and_equal_brute_force(spark, make_docs):
    texts = EDGE_TEXTS + [f"text {k} " * (k % 90) for k in range(150)]
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(texts))]
    docs = make_docs(texts, ids=ids)
    found = [slots(order.token_records(docs.repartition(n), FILE, PATTERN, sequence=16), seed=3) for n in (1, 3, 17)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "20")
    found.append(slots(order.token_records(docs.repartition(5), FILE, PATTERN, sequence=16), seed=3))
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS h0", "xxhash64(text, 1, doc_id) AS h1").collect()
    numbered = [(r.doc_id, p, ids[p * 16 : p * 16 + 16]) for r in sorted(keyed, key=lambda r: (r.h0, r.h1)) for ids in [ENCODING.encode_ordinary(r.text or "")] for p in range(-(-len(ids) // 16))]
    want = {(i, p, plain_feistel(k, len(numbered), 3)) for k, (i, p, _) in enumerate(numbered)}
    assert all({(i, p, s) for i, p, _, s in f} == want for f in found)


def test_shards_are_whole_or_refused(spark, make_docs, tmp_path):
    ordered = order.training_order(order.token_records(make_docs([f"text {k} " * (k % 90) for k in range(120)]), FILE, PATTERN, sequence=16), shard_records=50)
    rows = {r.slot: r.doc_id for r in ordered.collect()}
    path = str(tmp_path / "bounded")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "20")
    order.write_shards(ordered, path)
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    shards = sorted((tmp_path / "bounded").glob("shard=*"))
    assert all(len(list(s.glob("part-*"))) == 1 for s in shards) and len(shards) > 3
    assert {r.slot: r.doc_id for r in order.read_slots(spark, path, 0, len(rows) + 99, 16, 50).collect()} == rows
    assert order.read_slots(spark, path, 9, 9, 16, 50).count() == order.read_slots(spark, path, len(rows) + 60, len(rows) + 99, 16, 50).count() == 0
    # a shard in two files reads right, a torn one and a missing one raise
    file = next((tmp_path / "bounded" / "shard=1").glob("part-*"))
    step, content = order.stride(16) + 1, file.read_bytes()
    (file.parent / file.name.replace("part-", "part-9")).write_bytes(content[20 * step :])
    file.write_bytes(content[: 20 * step])
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert {r.slot: r.doc_id for r in order.read_slots(spark, path, 0, len(rows), 16, 50).collect()} == rows
    file.write_bytes(content[: 19 * step])
    with pytest.raises(Exception, match="short or torn"):
        order.read_slots(spark, path, 0, 99, 16, 50).collect()
    assert order.read_slots(spark, path, 0, 50, 16, 50).count() == 50
    for f in (tmp_path / "bounded" / "shard=1").iterdir():
        f.unlink()
    (tmp_path / "bounded" / "shard=1").rmdir()
    with pytest.raises(ValueError, match="lacks 1"):
        order.read_slots(spark, path, 0, 50, 16, 50)
