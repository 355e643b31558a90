"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

Texts, sorted by a hash of id and text, become byte-level BPE ids, cut into sequences of a fixed length; a
sequence is a record of fixed size: document id, part, number of ids (little-endian header), then the ids,
padded. All records are numbered 0 to n-1 in that order, which depends on the rows alone and not on how the table
was split. A Feistel network keyed by a seed permutes the least even number of bits that holds n; values of n and
over walk on along their cycle until they fall below n. So each record has a global slot, computed from its
number: nothing is shuffled to draw the order, and any run with the same rows and seed repeats it.

Records are range-partitioned by shard, a fixed number of slots each, and sorted. In a written shard the
record of a slot starts at a known byte, so a reader that can seek resumes anywhere; ``read_slots`` reads the
files of the shards that it needs whole.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sharding import mixed_keys
from .shared import shared_path, slices

#: Ids of a sequence, and records of a shard.
SEQUENCE, SHARD_RECORDS = 256, 8192
ROUNDS = 6
#: Document id, part, number of ids.
RECORD_HEADER = "<qii"
HEADER_BYTES = struct.calcsize(RECORD_HEADER)
#: Fills a sequence up; the number of ids in the header tells it from text.
PADDING_ID = 0
#: A byte between the records of a written shard: Spark's text sink needs a line end.
SYNC = b"\n"
MAX_VOCABULARY_BYTES = 64 << 20
#: Offsets of up to so many files are broadcast; those of more are joined by a shuffle.
MAX_BROADCAST_FILES = 500_000


def feistel(index: np.ndarray, n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slot in 0..n-1 of each index in 0..n-1: a bijection for each seed."""
    half = max(1, ((max(1, n - 1)).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mixed_keys(np.arange(rounds) + np.int64(seed) * rounds)
    out = index.astype(np.uint64)
    live = np.arange(len(out))
    while len(live):
        x = out[live]
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (mixed_keys(right ^ key) & mask)
        out[live] = left << shift | right
        live = live[out[live] >= np.uint64(n)]
    return out.astype(np.int64)


def slot_of(index: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(np.int64), n, seed))

    return slot(index)


def stride(sequence: int = SEQUENCE) -> int:
    """Bytes of a record."""
    return HEADER_BYTES + 2 * sequence


def token_records(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """(id, part, n_tokens, record) rows: each text's ids, ``sequence`` a record, the last one padded; in an order that
    depends on ids and texts alone.

    ``vocabulary`` is a file of base64 tokens and ranks, ``pattern`` its pre-tokeniser. Whole texts are
    encoded, however long; null and empty texts give no record. A null id is written as -1 and stays null in
    ``id``. Repeated rows give records of their own. Other columns are not read, whatever their names; an empty table
    gives no records. Ids that are not numbers become null.
    """
    with open(vocabulary, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is over {MAX_VOCABULARY_BYTES} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
        if max(ranks.values(), default=0) >= 1 << 16:
            raise ValueError("ids must fit into two bytes")
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in slices(batches, "text"):
            ids, parts, sizes, records = [], [], [], []
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tokens = np.array(encoding.encode_ordinary(text or ""), np.uint16)
                for part in range(-(-len(tokens) // sequence)):
                    own = tokens[part * sequence : (part + 1) * sequence]
                    ids.append(doc)
                    parts.append(part)
                    sizes.append(len(own))
                    records.append(struct.pack(RECORD_HEADER, -1 if doc is None else doc, part, len(own)) + own.tobytes() + struct.pack("<H", PADDING_ID) * (sequence - len(own)))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(records, pa.binary())], ["id", "part", "n_tokens", "record"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # rows that agree in both hashes are the same; the last key only spreads them over partitions
    hashed = source.select("id", "text", F.xxhash64("id", "text").alias("h0"), F.xxhash64("text", F.lit(1), "id").alias("h1"), F.monotonically_increasing_id().alias("at"))
    ordered = hashed.repartitionByRange("h0", "h1", "at").sortWithinPartitions("h0", "h1", "at").select("id", "text")
    return ordered.mapInArrow(run, "id long, part int, n_tokens int, record binary")


def training_order(records: DataFrame, seed: int = 7, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """``records`` with slot, shard and byte_offset (in the written shard), range-partitioned by shard and
    sorted by slot. Slots are a permutation of 0..n-1; no records give no rows.

    Records are numbered as they come: the order of ``token_records`` is the same however the table is split.
    They are first stored in the shared folder: their number is their file's offset and their row in it.
    """
    spark = records.sparkSession
    path = shared_path(spark, "records")
    records.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(records.schema).parquet(path)
    # a file is named after its task and its place among the task's files
    name = F.col("_metadata.file_name")
    task, piece = (F.regexp_extract(name, pattern, 1).cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)[^-]*$"))
    placed = table.select("*", (task * (1 << 20) + piece).alias("file"), F.col("_metadata.row_index").alias("row"))
    files = placed.groupBy("file").agg(F.count("*").alias("n"))
    # a row a file, that is a row a task of the first step
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    size = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    if size.files <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    numbered = placed.join(offsets, "file").withColumn("slot", slot_of(F.col("offset") + F.col("row"), size.n, seed))
    width = F.octet_length("record") + len(SYNC)
    slotted = numbered.withColumn("shard", F.floor(F.col("slot") / shard_records).cast("int")).withColumn("byte_offset", (F.col("slot") % shard_records) * width)
    return slotted.repartitionByRange("shard").sortWithinPartitions("shard", "slot").select("slot", "shard", "byte_offset", F.col("id").alias("doc_id"), "part", "n_tokens", "record")


def write_shards(ordered: DataFrame, path: str) -> None:
    """The records of ``training_order`` as raw files: ``path/shard=k/part-*.txt``, one file a shard.

    No records write no shard. An existing ``path`` raises and is left as it is.
    """
    # the text sink writes a string's bytes as they are; a shard lies in one partition, and a session's bound on
    # the rows of a file would cut it
    rows = ordered.select("shard", F.col("record").cast("string").alias("value"))
    rows.write.partitionBy("shard").option("lineSep", SYNC.decode()).option("maxRecordsPerFile", 0).text(path)


def read_slots(spark: SparkSession, path: str, start: int, stop: int, sequence: int = SEQUENCE, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(slot, doc_id, part, tokens) of the slots from ``start`` up to ``stop``, in no order between shards; a null id
    reads as -1. ``stop`` at or below ``start``, and slots after the last, give no rows.

    Only the shards of the range are read. All shards but the last must hold their whole number of records, in
    however many files, which follow each other by name; a shard that is short, cut off or missing before the
    last one raises.
    """
    step = stride(sequence) + len(SYNC)
    found = "slot long, doc_id long, part int, tokens array<int>"
    if stop <= start:
        return spark.createDataFrame([], found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, content in zip(batch.column("first").to_pylist(), batch.column("content").to_pylist(), strict=True):
                own = range(max(start, first), min(stop, first + len(content) // step))
                rows = [content[(s - first) * step : (s - first + 1) * step - len(SYNC)] for s in own]
                heads = [struct.unpack_from(RECORD_HEADER, r) for r in rows]
                tokens = [np.frombuffer(r, np.uint16, h[2], HEADER_BYTES).astype(np.int32) for r, h in zip(rows, heads, strict=True)]
                yield pa.record_batch([pa.array(list(own), pa.int64()), pa.array([h[0] for h in heads], pa.int64()), pa.array([h[1] for h in heads], pa.int32()), pa.array(tokens, pa.list_(pa.int32()))], ["slot", "doc_id", "part", "tokens"])

    files = spark.read.format("binaryFile").load(path).withColumn("shard", F.col("shard").cast("int"))
    # lengths come from the listing; no content is read for them
    sizes = files.groupBy("shard").agg(F.sum("length").alias("size"), F.count_if(F.col("length") % step != 0).alias("torn"))
    ends = sizes.agg(F.coalesce(F.max("shard"), F.lit(-1)).alias("last"), F.count("*").alias("there")).first()
    if ends.there != ends.last + 1:
        raise ValueError(f"{path} lacks {ends.last + 1 - ends.there} shards")
    own = F.col("shard").between(start // shard_records, (stop - 1) // shard_records)
    whole = (F.col("torn") == 0) & ((F.col("shard") == ends.last) | (F.col("size") == shard_records * step))
    judged = sizes.where(own).select("shard", F.when(whole, F.col("size")).otherwise(F.raise_error(F.lit("a shard is short or torn")).cast("long")).alias("size"))
    before = F.coalesce(F.sum("length").over(Window.partitionBy("shard").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.where(own).select("shard", "path", "length").withColumn("before", before).join(judged, "shard")
    # the size is named so that the check is not pruned away
    placed = starts.select(F.col("path").alias("file"), (F.col("shard").cast("long") * shard_records + F.col("before") / step).cast("long").alias("first"), "size").where("size >= 0")
    read = files.where(own).join(placed, F.col("path") == F.col("file")).select("first", "content")
    return read.mapInArrow(run, found)
