from pyspark.sql import functions as F

from curatrix.operators import dedup


def test_hash_pairs_of_many_bits_need_no_bands(spark, monkeypatch):
    """20 bits leave bands of 3 bits, in which an eighth of all hashes meets: 21 such joins against every pair once."""
    monkeypatch.setattr(dedup, "BLOCK", 50)
    hashes = spark.range(400).select(F.xxhash64("id").alias("h"))
    near = dedup.hash_pairs(hashes.unionByName(hashes.limit(7)), 20)
    values = [r.h for r in hashes.collect()]
    want = {(a, b, d) for a in values for b in values if a < b and (d := ((a ^ b) & (1 << 64) - 1).bit_count()) <= 20}
    found = [tuple(r) for r in near.collect()]
    assert want and len(found) == len(want) and set(found) == want
    assert "inline" not in near._jdf.queryExecution().toString()
