"""Exact top-k inner-product search by norm-bucketed retrieval.

Vectors are sorted by length into buckets of a fixed size; a bucket is one row that holds a dense
matrix. Queries are packed into blocks in the same way. The longest bucket gives each query a first
bound, its k-th best score there. A block then meets only the buckets whose length can reach one of
its bounds, and in each bucket a query is answered by its local cosine threshold, bound / (length of
the query x greatest length of the bucket):

* over 1: nothing in the bucket can reach the bound;
* high: coordinate pruning. On the query's strongest coordinate, a vector must lie in the interval
  that the threshold leaves it; the bucket's vectors in that interval are the candidates;
* low: length pruning. Only the leading vectors, long enough to reach the bound, are candidates.

Candidates' products are then computed exactly. Blocks and buckets meet by an equality join on a lane
number: each bucket has one lane, each block goes to all lanes, so every block meets every bucket once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed

#: Rows of a bucket and of a query block: the unit of work and of memory.
BUCKET_ROWS, BLOCK_ROWS = 2048, 256
#: Lanes that buckets are dealt over: at least so many, and so many buckets a lane up to the greatest number. A lane
#: is what one task answers, so that the tasks grow with the buckets; each block of queries is sent to all lanes.
LANES, LANE_BUCKETS, MOST_LANES = 64, 64, 4096
#: From this local cosine threshold on, coordinate pruning pays.
COORDINATE_FROM = 0.6
#: Integers below this size are exact in a double.
EXACT = float(1 << 53)

PACKED = "pack long, ids array<long>, rows array<long>, n int, dim int, top double, low double, data binary"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null if the vector or a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    usable = vector.isNotNull() & ~F.coalesce(F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def _pack(rows: DataFrame, size: int, with_bound: bool = False) -> DataFrame:
    """Rows (row, id, v, norm) of each partition, in its order, packed ``size`` a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []

        def packed(table: pa.Table) -> pa.RecordBatch:
            nonlocal count
            vectors = table.column("v").combine_chunks()
            lengths = np.diff(vectors.offsets.to_numpy())
            dim = int(lengths.max(initial=0))
            matrix = np.zeros((table.num_rows, dim), np.int64)
            # shorter vectors are filled up with zeros
            matrix[np.arange(dim) < lengths[:, None]] = vectors.flatten().to_numpy()
            norms = table.column("norm").to_numpy()
            low = table.column("low").to_numpy() if with_bound else np.zeros(0)
            count += 1
            return pa.record_batch([[part + count], [table.column("id").to_pylist()], [table.column("row").to_pylist()], [table.num_rows], [dim], [float(norms.max())], [float(low.min(initial=np.inf))], [matrix.tobytes()]], schema=pa.schema([("pack", pa.int64()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("n", pa.int32()), ("dim", pa.int32()), ("top", pa.float64()), ("low", pa.float64()), ("data", pa.binary())]))

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                while table.num_rows >= size:
                    yield packed(table.slice(0, size))
                    table = table.slice(size)
                held = table.combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held))

    return rows.mapInArrow(run, PACKED)


def _matrix(row: dict, prefix: str) -> np.ndarray:
    return np.frombuffer(row[f"{prefix}data"], np.int64).reshape(row[f"{prefix}n"], row[f"{prefix}dim"])


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of some candidates without the query's own row, ties to smaller ids."""
    other = rows != own
    scores, ids = scores[other], ids[other]
    if len(scores) > k:
        # all that tie with the k-th stay until ids decide
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_bucket(queries: np.ndarray, q_rows: np.ndarray, bounds: np.ndarray, bucket: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position of the query, scores, ids): of each query its k best in the bucket that reach its bound. ``q_rows`` and
    ``own`` are the row numbers of queries and bucket.

    ``bucket`` is sorted by length, longest first. Bounds of -inf prune nothing.
    """
    dim = min(queries.shape[1], bucket.shape[1])
    q, c = queries[:, :dim].astype(np.float64), bucket[:, :dim].astype(np.float64)
    q_len, c_len = np.sqrt((queries.astype(np.float64) ** 2).sum(1)), np.sqrt((bucket.astype(np.float64) ** 2).sum(1))
    top = c_len.max(initial=0.0)
    exact = q_len.max(initial=0.0) * top < EXACT

    def products(rows: np.ndarray | slice, at: np.ndarray | int) -> np.ndarray:
        return (c[rows] @ q[at].T).astype(np.int64) if exact else bucket[rows, :dim] @ queries[at, :dim].T

    # a hair under the bound, so that rounding never prunes what reaches it
    floor = bounds - 1e-9 * np.abs(bounds) - 1e-6
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(floor > 0, floor / (q_len * top), -1.0)
    live = np.flatnonzero(~(local > 1.0))
    by_length = live[local[live] < COORDINATE_FROM]
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(floor[by_length] > 0, floor[by_length] / q_len[by_length], 0.0)
        long_enough = len(c_len) - np.searchsorted(c_len[::-1], need, side="left")
        scores = products(slice(0, int(long_enough.max(initial=0))), by_length)
        for column, at in enumerate(by_length):
            rows = slice(0, int(long_enough[column]))
            got = scores[rows, column]
            reach = got >= bounds[at]
            if reach.any():
                yield at, *_best(got[reach], ids[rows][reach], own[rows][reach], q_rows[at], k)
    unit = None
    for at in live[local[live] >= COORDINATE_FROM]:
        if unit is None:
            unit = c / np.maximum(c_len, 1e-300)[:, None]
        focus = int(np.abs(q[at]).argmax())
        x, t = q[at, focus] / q_len[at], min(1.0, local[at])
        # cos >= t leaves the focus coordinate between x*t -+ sqrt(1-x^2)*sqrt(1-t^2)
        slack = np.sqrt(max(0.0, 1 - x * x)) * np.sqrt(max(0.0, 1 - t * t)) + 1e-9
        side = unit[:, focus]
        high = x * t + slack if x <= t else 1.0
        least = x * t - slack if x >= -t else -1.0
        rows = np.flatnonzero((side >= least) & (side <= high))
        if len(rows):
            got = products(rows, at)
            reach = got >= bounds[at]
            if reach.any():
                yield at, *_best(got[reach], ids[rows][reach], own[rows][reach], q_rows[at], k)


def top_k(vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", query_mod: int = 100, scale: int = 1024) -> DataFrame:
    """The k highest integer inner products of each query with all other rows: query_id, rank (from 1),
    vec_id, score. Components count as floor(scale * x).

    Queries are the rows whose id is divisible by ``query_mod``; all rows are candidates but the query's own,
    others of its id too. Fewer than k candidates give fewer rows. Ties go to the smaller id. Vectors that
    are null or hold null or non-finite components, and rows with a null id, take no part. Of unequal
    lengths, the shorter vector is filled up with zeros. Repeated rows are candidates each; a repeated
    query is answered for each of its rows. Scaled components beyond 64 bits raise an error. Other columns are not read.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).where("id is not null and v is not null")
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    ordered = rows.repartitionByRange(F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"), F.asc("id"))
    buckets = checkpointed(_pack(ordered, BUCKET_ROWS))
    queries = rows.where(F.col("id") % query_mod == 0)
    blocks = checkpointed(_pack(queries.withColumn("low", F.lit(float("-inf"))), BLOCK_ROWS, with_bound=True))
    # one bucket, a fixed number of rows
    seed = buckets.orderBy(F.desc("top"), "pack").limit(1).select(*(F.col(c).alias(f"c_{c}") for c in ("ids", "rows", "n", "dim", "data")))
    first = F.broadcast(seed.withColumn("one", F.lit(1)))
    q_side = blocks.select("pack", *(F.col(c).alias(f"q_{c}") for c in ("ids", "rows", "n", "dim", "top", "data")))

    def bounds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, q_rows = _matrix(row, "q_"), np.array(row["q_rows"])
                bounds = np.full(len(q_rows), -np.inf)
                for at, scores, _ in search_bucket(q, q_rows, bounds.copy(), _matrix(row, "c_"), np.array(row["c_ids"]), np.array(row["c_rows"]), k):
                    if len(scores) == k:
                        bounds[at] = scores[-1]
                lengths = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                reach = np.where(bounds > 0, bounds / np.maximum(lengths, 1e-300), 0.0)
                yield pa.record_batch([[row["pack"]], [row["q_ids"]], [row["q_rows"]], [row["q_n"]], [row["q_dim"]], [row["q_data"]], [bounds.tolist()], [float(reach.min(initial=np.inf))]], schema=pa.schema([("pack", pa.int64()), ("q_ids", pa.list_(pa.int64())), ("q_rows", pa.list_(pa.int64())), ("q_n", pa.int32()), ("q_dim", pa.int32()), ("q_data", pa.binary()), ("bounds", pa.list_(pa.float64())), ("needs", pa.float64())]))

    bounded = q_side.withColumn("one", F.lit(1)).join(first, "one").drop("one").mapInArrow(bounds_of, "pack long, q_ids array<long>, q_rows array<long>, q_n int, q_dim int, q_data binary, bounds array<double>, needs double")
    n_lanes = min(MOST_LANES, max(LANES, buckets.count() // LANE_BUCKETS))
    lanes = bounded.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(n_lanes - 1))))
    dealt = buckets.select(F.pmod(F.hash("pack"), F.lit(n_lanes)).alias("lane"), F.col("top").alias("c_top"), *(F.col(c).alias(f"c_{c}") for c in ("ids", "rows", "n", "dim", "data")))
    pairs = dealt.join(lanes, "lane").where(F.col("c_top") >= F.col("needs") * (1 - 1e-9))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                q_ids, q_rows = np.array(row["q_ids"]), np.array(row["q_rows"])
                found = list(search_bucket(_matrix(row, "q_"), q_rows, np.array(row["bounds"]), _matrix(row, "c_"), np.array(row["c_ids"]), np.array(row["c_rows"]), k))
                if found:
                    sizes = [len(ids) for _, _, ids in found]
                    at = [f[0] for f in found]
                    yield pa.record_batch([pa.array(np.repeat(q_rows[at], sizes)), pa.array(np.repeat(q_ids[at], sizes)), pa.array(np.concatenate([f[2] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], ["query", "query_id", "vec_id", "score"])

    found = pairs.select("q_ids", "q_rows", "q_n", "q_dim", "q_data", "bounds", "c_ids", "c_rows", "c_n", "c_dim", "c_data").mapInArrow(verify, "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
