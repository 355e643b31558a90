"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits. Of two fingerprints that differ in at most 2 bits, one of the two
halves differs in at most one bit. Each half is indexed under its 32 variants with one bit deleted:
halves that differ in one bit meet under the variant without that bit, equal halves under all. So each
fingerprint gives 64 keys; fingerprints with an equal key are compared and verified.

Fingerprints, not documents, are indexed: exact copies cost nothing more. The rows of a key are sorted
together and stream through a task, which links the near ones to their smallest instead of writing all
pairs: n fingerprints give fewer than n links. Halves that more than RUN_ROWS fingerprints have are counted first and
not indexed, so that a key, which joins two halves, has twice as many rows at most and no task holds a hot one. Their
fingerprints, and those of keys over RUN_ROWS, are indexed once more with every two bits deleted: there four
fingerprints at most share a key, differ in two bits at most and are linked without comparing. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .shared import checkpointed, shared_path, slices

SHINGLE_WORDS, MAX_DISTANCE, SEED = 3, 2, 42
#: Fingerprints of one key that a task compares in memory.
RUN_ROWS = 8192
#: Fingerprints that a task indexes, each under 64 keys.
INDEX_ROWS = 1 << 14
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, as unsigned integer; 0 for a text without words."""
    # bytes.split cuts at the ASCII white space \x20 and \x09-\x0D
    words = text.encode().translate(LOWER_BYTES).split()
    if not words:
        return 0
    n = len(words) - shingle_words + 1
    if n < 2:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words)), strict=False))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) of each row; fp is the fingerprint's 64 bits as a long. Null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = np.array([fingerprint(t or "", shingle_words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("id"), pa.array(prints.view(np.int64))], ["id", "fp"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fp long")


def near_links(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest of its class) for sorted distinct unsigned fingerprints of one key."""
    rest, ends, roots = prints, [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= distance
            if near.any():
                found = rest[near]
                queue.extend(found)
                ends.append(found)
                roots.append(np.full(len(found), root))
                rest = rest[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(ends), np.concatenate(roots)) if ends else (none, none)


def _linked(keyed: DataFrame, keys: list[str], distance: int, run_rows: int) -> DataFrame:
    """(a, b) links among the rows of each key, b null for a row of a key over ``run_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current: tuple | None = None
        hot = False

        def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            nulls = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
            return pa.record_batch([pa.array(a.view(np.int64)), nulls], ["a", "b"])

        def close() -> Iterator[pa.RecordBatch]:
            prints = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            if len(prints) > 1:
                ends, roots = near_links(prints, distance)
                if len(ends):
                    yield out(ends, roots)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            prints = batch.column("fp").to_numpy().view(np.uint64)
            marks = [batch.column(k).to_numpy() for k in keys]
            change = np.zeros(n, bool)
            for m in marks:
                change[1:] |= m[1:] != m[:-1]
            starts = np.flatnonzero(change)
            edges = np.concatenate(([0], starts, [n]))
            # runs of one row inside the batch have no partner
            inner = np.flatnonzero((np.diff(edges) > 1) | (np.arange(len(edges) - 1) == 0) | (np.arange(len(edges) - 1) == len(edges) - 2))
            for k in inner:
                lo, hi = edges[k], edges[k + 1]
                key = tuple(m[lo] for m in marks)
                if key != current:
                    yield from close()
                    held, current, hot = [], key, False
                if hot:
                    yield out(prints[lo:hi], None)
                    continue
                held.append(prints[lo:hi])
                if sum(map(len, held)) > run_rows:
                    for part in held:
                        yield out(part, None)
                    held, hot = [], True
        yield from close()

    return keyed.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "fp").mapInArrow(run, "a long, b long")


def _half(fp: Column, high: bool) -> Column:
    return F.shiftrightunsigned(fp, 32) if high else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(half: Column, high: bool) -> Column:
    """The 32 one-bit deletions of a half; each key holds the half's side, the bit and the rest of the half."""
    return F.array(*(F.lit((32 * high + bit) << 32).bitwiseOR(half.bitwiseAND(F.lit(~(1 << bit)))) for bit in range(32)))


def _signed(mask: int) -> int:
    """A mask of 64 bits as Spark's long."""
    return (mask + (1 << 63)) % (1 << 64) - (1 << 63)


def hamming_links(prints: DataFrame, distance: int = MAX_DISTANCE, run_rows: int = RUN_ROWS) -> DataFrame:
    """Links (a, b) that connect the same fingerprints as all pairs within ``distance`` bits (1 or 2).

    ``prints`` has one column fp of distinct longs.
    """
    if distance not in (1, 2):
        raise ValueError("the distance is 1 or 2")
    prints = checkpointed(prints)
    spread = prints.repartition(prints.count() // INDEX_ROWS + 1)
    sides, hot = [], []
    for high in (False, True):
        half = _half(F.col("fp"), high).alias("half")
        heavy = prints.groupBy(half).agg(F.count("*").alias("n")).where(F.col("n") > run_rows).select("half")
        own = spread.select("fp", half)
        keys = F.explode(_variants(F.col("half"), high)).alias("key")
        if heavy.isEmpty():
            sides.append(own.select("fp", keys))
            continue
        # the keys of such halves, few as they are, take the fingerprints of other halves along
        hot_keys = heavy.select(keys)
        keyed = own.join(heavy, "half", "left_anti").select("fp", keys)
        hot += [own.join(heavy, "half", "left_semi").select("fp"), keyed.join(hot_keys, "key", "left_semi").select("fp")]
        sides.append(keyed.join(hot_keys, "key", "left_anti"))
    found = checkpointed(_linked(sides[0].unionByName(sides[1]), ["key"], distance, run_rows))
    links = found.where("b is not null").distinct()
    crowded = found.where("b is null").select(F.col("a").alias("fp"))
    for more in hot:
        crowded = crowded.unionByName(more)
    crowded = crowded.distinct()
    if crowded.isEmpty():
        return links
    # a fixed number of masks, 2016 for two bits
    masks = F.array(*(F.lit(_signed(~sum(1 << bit for bit in bits))) for bits in combinations(range(64), distance)))
    deleted = crowded.select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("rest"))
    return links.unionByName(_linked(deleted, ["mask", "rest"], distance, 1 << (distance + 1)).where("b is not null")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per document: id_col, fingerprint (16 lower-case hex digits), component_id, the smallest id
    reachable over links of ``distance`` or fewer differing bits, the document's own included.

    Words are cut at ASCII white space and A-Z lower-cased; shingles count with repeats; fewer words than a
    shingle are one shingle. Texts without words, null ones too, have the fingerprint 0 and link like any
    other. A null id is never the smallest unless the class has no other. Repeated rows are kept; other
    columns are not read. An empty table gives an empty table.
    """
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle_words))
    classes = rows.groupBy("fp").agg(F.min("id").alias("first"))
    parts = connected_components(hamming_links(rows.select("fp").distinct(), distance, run_rows))
    rooted = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    # only classes that have a link need the smallest id of their component
    linked = rooted.where("component is not null")
    firsts = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(firsts, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(F.col("id").alias(id_col), text.alias("fingerprint"), "component_id")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored with the columns d0, d1, ... and row, a number of its own for each row."""
    names = [f"d{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("row", F.monotonically_increasing_id())
    path = shared_path(docs.sparkSession, "numbered")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def drop_joined(rows: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with one row of each component: the one of the smallest id, null ids last, then of the smallest row.

    ``nodes`` has (row, id, node) of each row, ``parts`` the component of each node that has a link.
    """
    rooted = nodes.join(parts.withColumnRenamed("component", "root"), "node", "left").select("row", F.col("id").isNull().alias("unnamed"), "id", F.coalesce("root", "node").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min(F.struct("unnamed", "id", "row")).alias("first"))
    dropped = rooted.join(firsts, "root").where("row <> first.row").select("row")
    return rows.join(dropped, "row", "left_anti").drop("row")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, run_rows: int = RUN_ROWS) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the one of the smallest id, null ids last.

    Rows are chosen, not ids: null and repeated ids neither join groups nor leave one without a row. Null and empty
    texts have the fingerprint 0 and are one group. All columns are kept unchanged, whatever their names.
    """
    rows = numbered(docs)
    own, text = (f"d{docs.columns.index(c)}" for c in (id_col, text_col))
    named = rows.select(F.struct("row", F.col(own).alias("id")).alias("key"), F.col(text).alias("text"))
    prints = checkpointed(fingerprints(named, "key", "text", shingle_words))
    nodes = prints.select("id.row", "id.id", F.col("fp").alias("node"))
    parts = connected_components(hamming_links(prints.select("fp").distinct(), distance, run_rows))
    return drop_joined(rows, nodes, parts).toDF(*docs.columns)
