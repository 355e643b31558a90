"""Near copies of texts by wide SimHashes and deletion-variant signatures, verified on the texts.

Texts link if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more. At 0.8 two SimHashes
over these sets differ in 15% of their bits, so 64 bits tell little; here a fingerprint has some hundred. It is
cut into segments so short that in one of them near copies differ by at most one bit. Each segment is indexed
under its variants with one bit deleted; texts that share a variant are candidates.

Variants are not written out. Values that differ in one bit at most agree in their first or in their second half, so
a row of a segment goes to the group of each of its halves and a bit of the other half is deleted where the group
is: a row costs two shuffled rows a segment, however many texts there are, and not one for each bit. Three more words
of the fingerprint, the sketch, ride along and turn away texts that share a variant by chance.

The index is searched twice. At first the texts of an equal segment are compared with the middle one of them
alone, which joins most copies of a text; the second search leaves out what is in one component already, so that
n copies take about n comparisons and not n * n. It compares all others that share a variant: nothing is
capped. Candidates are verified on the sets, those first that differ least.

Texts that the first search finds near many others, edited copies of one text mostly, are the crowd. Among them
the second search uses one more test: a shingle that one text alone of the crowd has is in no intersection and
in every union, so the numbers of shared shingles, counted in SHARES parts of the hashes, and of all shingles bound a
pair's similarity from above. Pairs whose bound is too low are never written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .shared import checkpointed, compact, counted, fitted, slices
from .sharding import mixed_keys
from .simhash import LOWER_BYTES, SEED, drop_joined, numbered

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: A pair at the least similarity shares no variant with this probability.
MISS = 2e-4
#: Bits of a segment at least; they grow with the logarithm of the texts.
SEGMENT_BITS = 16
#: Words of the sketch, and in how many of its bits candidates may differ: 0.8 gives 29 of 192, chance 96, a third of the
#: shingles in common 67.
SKETCH_WORDS, SKETCH_DISTANCE = 3, 48
SKETCH = [f"s{k}" for k in range(SKETCH_WORDS)]
#: In the first search texts with nearer sketches are linked, with the middle one of a run of more than SMALL_RUN.
FIRST_DISTANCE, SMALL_RUN = 43, 4
#: Rows of a run that are compared step by step; those of a larger one go component by component.
RUN_ROWS = 64
#: Partners of a text that are verified in the first round; then so many times more each round.
NEAREST, MORE = 2, 32
#: Fingerprints that differ by so many standard deviations more than a pair at the least similarity are not verified;
#: sets of fewer shingles than SMALL scatter more and are verified up to a wider limit.
DEVIATIONS, SMALL, SMALL_SHARE = 4.0, 32, 0.3
#: A text with more candidates than this in the first search is in the crowd.
CROWD = 4
#: Parts, by their hashes' last bits, in which the shared shingles of a text of the crowd are counted.
SHARES = 32
#: The part that all of them have in the search of the others: no text's own hash but by a chance of 1 in 2**64.
CROWD_PART = 0
#: Rows of whole shingle sets that a task verifies, and pairs that a task of the index gives on at once.
SET_ROWS, PAIR_ROWS = 500, 1 << 16
#: Shingles whose bits are counted at once.
BLOCK = 255 * 16


def words_of(text: str) -> list[bytes]:
    """The words at ASCII white space, A-Z lower-cased."""
    return text.encode().translate(LOWER_BYTES).split()


def shingle_set(words: list[bytes], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than a shingle are one."""
    n = len(words) - shingle_words + 1
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words)), strict=False))
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n))


def wide_print(shingles: np.ndarray, width: int) -> np.ndarray:
    """The SimHash of a set in ``width`` 64-bit words; a bit is 1 if set in over half the shingles' own bits."""
    seeds = mixed_keys(np.arange(1, width + 1))
    ones = np.zeros(64 * width, np.int64)
    for at in range(0, len(shingles), BLOCK):
        own = mixed_keys(shingles[at : at + BLOCK, None] ^ seeds)
        bits = np.unpackbits(own.view(np.uint8), axis=1, bitorder="little")
        # up to 255 bits sum up in a byte
        ones += np.add.reduceat(bits, np.arange(0, len(own), 255), axis=0, dtype=np.uint8).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles), bitorder="little").view(np.uint64)


class Layout:
    """How ``n`` texts are indexed: ``segments`` of ``bits``, the longer ``half`` of these, words in all."""

    def __init__(self, n: int, similarity: float = SIMILARITY) -> None:
        size = max(1, n).bit_length()
        self.bits = max(SEGMENT_BITS, size - 2)
        self.half = -(-self.bits // 2)
        differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
        shares = (1 - differ) ** self.bits + self.bits * differ * (1 - differ) ** (self.bits - 1)
        self.segments = math.ceil(math.log(MISS) / math.log(1 - shares))
        self.width = -(-self.segments * self.bits // 64) + SKETCH_WORDS
        #: Bits in which candidates may differ, of large sets and of small ones.
        n_bits = 64 * self.width
        self.limits = int(n_bits * differ + DEVIATIONS * math.sqrt(n_bits * differ * (1 - differ))), int(n_bits * SMALL_SHARE)

    def values(self, prints: np.ndarray) -> np.ndarray:
        """The segments' values (a row a text) of fingerprints."""
        bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little", count=self.segments * self.bits)
        powers = np.left_shift(np.uint64(1), np.arange(self.bits, dtype=np.uint64))
        return bits.reshape(len(prints), self.segments, self.bits) @ powers


def _near(sketches: np.ndarray, a: np.ndarray, b: np.ndarray | int, limit: int) -> np.ndarray:
    return np.bitwise_count(sketches[a] ^ sketches[b]).sum(1) <= limit


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, length) of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate(([True], marks[1:] != marks[:-1])))
    return starts, np.diff(np.append(starts, len(marks)))


def _steps(at: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of each run of ``most`` rows or fewer, one distance in the run after the other."""
    room = np.repeat(starts + sizes, sizes) - np.arange(len(at))
    room[np.repeat(sizes > most, sizes)] = 0
    own, step = np.flatnonzero(room > 1), 1
    while len(own):
        yield at[own], at[own + step]
        step += 1
        own = own[room[own] > step]


def middle_pairs(values: np.ndarray, sketches: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of equal values with near sketches: all of a small run, those with the middle row of a large one,
    whose sketch differs least from the bits that most of the run have."""
    at = np.argsort(values, kind="stable")
    starts, sizes = _runs(values[at])
    for a, b in _steps(at, starts, sizes, SMALL_RUN):
        found = _near(sketches, a, b, FIRST_DISTANCE)
        yield a[found], b[found]
    for k in np.flatnonzero(sizes > SMALL_RUN):
        rows = at[starts[k] : starts[k] + sizes[k]]
        bits = np.unpackbits(sketches[rows].view(np.uint8), axis=1, bitorder="little")
        common = 2 * bits.sum(0, dtype=np.int64) > len(rows)
        middle = rows[(bits != common).sum(1).argmin()]
        found = rows[(np.bitwise_count(sketches[rows] ^ sketches[middle]).sum(1) <= FIRST_DISTANCE) & (rows != middle)]
        yield np.full(len(found), middle), found


def may_link(n: np.ndarray, shared: np.ndarray, a: np.ndarray, b: np.ndarray | int, similarity: float) -> np.ndarray:
    """Whether rows may have the similarity if they have ``n`` shingles, ``shared`` (by parts) of which other rows have too."""
    common = np.minimum(shared[a], shared[b]).sum(1)
    return common / (n[a] + n[b] - common) >= similarity


def near_pairs(values: np.ndarray, parts: np.ndarray, masks: list[int], near: Callable[[np.ndarray, np.ndarray | int], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of different parts whose values agree under one of the masks and that are ``near``."""
    for mask in masks:
        masked = values & np.uint64(mask)
        at = np.argsort(masked, kind="stable")
        starts, sizes = _runs(masked[at])
        for a, b in _steps(at, starts, sizes, RUN_ROWS):
            apart = parts[a] != parts[b]
            a, b = a[apart], b[apart]
            found = near(a, b)
            yield a[found], b[found]
        for k in np.flatnonzero(sizes > RUN_ROWS):
            rows = at[starts[k] : starts[k] + sizes[k]]
            # parts one after the other, the largest last: it is compared with the rows before it only
            _, part, n = np.unique(parts[rows], return_inverse=True, return_counts=True)
            rows = rows[np.lexsort((part, n[part]))]
            ends = np.cumsum(np.diff(np.append(_runs(parts[rows])[0], len(rows))))
            for first, last in zip(np.append(0, ends[:-2]), ends[:-1], strict=False):
                for row in rows[first:last]:
                    rest = rows[last:]
                    found = rest[near(rest, row)]
                    yield np.full(len(found), row), found


def _printed(texts: DataFrame, layout: Layout, shingle_words: int) -> DataFrame:
    """(row, id, node, n, fp) from (row, id, text): a hash of the words, the number of shingles and the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [words_of(t or "") for t in batch.column("text").to_pylist()]
            nodes = np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in words], np.uint64)
            sets = [shingle_set(w, shingle_words) for w in words]
            prints = [wide_print(own, layout.width).view(np.int64) for own in sets]
            yield pa.record_batch([batch.column("row"), batch.column("id"), pa.array(nodes.view(np.int64)), pa.array([len(own) for own in sets], pa.int64()), pa.array(prints, pa.list_(pa.int64()))], ["row", "id", "node", "n", "fp"])

    return texts.mapInArrow(run, f"row {texts.schema['row'].dataType.simpleString()}, id {texts.schema['id'].dataType.simpleString()}, node long, n long, fp array<long>")


def _sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    """(node, shingles) from (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(words_of(t or ""), shingle_words).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>")


def _index(prints: DataFrame, layout: Layout, whole: bool, counted: bool) -> DataFrame:
    """(key, the sketch, node), with part if ``whole`` and n and shared if ``counted``: the rows of the index, sorted in partitions of
    whole groups. A key numbers the segment, the half and its value, which make the group, and the other half's value. Without
    ``whole`` only the rows by their first halves."""
    half, low = layout.half, layout.bits - layout.half
    names = ["node", *(["part"] if whole else []), *(["n"] if counted else [])]
    binary = ["shared"] if counted else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                rows = batch.slice(at, 2048)
                matrix = rows.column("fp").flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, layout.width)
                values = layout.values(matrix)
                halves = values >> np.uint64(low), values & np.uint64((1 << low) - 1)
                first = np.arange(layout.segments, dtype=np.uint64)[None, :] * np.uint64(2)
                shared = rows.column("shared").flatten().to_numpy().reshape(rows.num_rows, SHARES) if counted else []
                own = [pa.array(np.repeat(np.array([c.tobytes() for c in shared], object), layout.segments), pa.binary())] if counted else []
                carried = [pa.array(np.repeat(rows.column(c).to_numpy(), layout.segments)) for c in names]
                sketch = np.repeat(matrix[:, -SKETCH_WORDS:].view(np.int64), layout.segments, axis=0)
                for side in (0, 1) if whole else (0,):
                    key = (((first + np.uint64(side)) << np.uint64(half)) | halves[side]) << np.uint64(half) | halves[1 - side]
                    yield pa.record_batch([pa.array(key.ravel().view(np.int64)), *(pa.array(sketch[:, k]) for k in range(SKETCH_WORDS)), *carried, *own], ["key", *SKETCH, *names, *binary])

    rows = prints.select(*names, *binary, "fp").mapInArrow(run, ", ".join([f"{c} long" for c in ("key", *SKETCH, *names)] + [f"{c} binary" for c in binary]))
    return rows.repartition(F.shiftright("key", half)).sortWithinPartitions("key")


def candidates(prints: DataFrame, layout: Layout, whole: bool, similarity: float | None = None) -> DataFrame:
    """Distinct pairs (a, b) of nodes that share a variant and have near sketches, from (node, part, fp): of
    different parts and all of them with ``whole``, else those of ``middle_pairs``. With a ``similarity``, which
    needs the columns n and shared, only the pairs that may have it."""
    half = layout.half
    rest = np.uint64((1 << half) - 1)

    def close(place: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        if table.num_rows < 2:
            return
        values, nodes = (table.column(c).to_numpy() for c in ("key", "node"))
        parts = table.column("part").to_numpy() if whole else nodes
        values = values.view(np.uint64) & rest
        sketches = np.stack([table.column(c).to_numpy() for c in SKETCH], axis=1).view(np.uint64)
        # the group's half is equal, of the other one bit may differ
        masks = [int(rest) ^ (1 << k) for k in range(half if (place >> half) % 2 else layout.bits - half)]

        if similarity is not None:
            n, shared = table.column("n").to_numpy(), np.frombuffer(b"".join(table.column("shared").to_pylist()), np.int32).reshape(-1, SHARES)

        def near(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
            found = _near(sketches, a, b, SKETCH_DISTANCE)
            if similarity is not None:
                at = np.flatnonzero(found)
                found[at] = may_link(n, shared, a[at], np.broadcast_to(b, len(a))[at], similarity)
            return found

        found: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            a, b = (nodes[np.concatenate([f[k] for f in found])] if found else nodes[:0] for k in (0, 1))
            once = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.record_batch([pa.array(once[:, 0]), pa.array(once[:, 1])], ["a", "b"])

        room = PAIR_ROWS
        for pair in near_pairs(values, parts, masks, near) if whole else middle_pairs(values, sketches):
            found.append(pair)
            room -= len(pair[0])
            if room <= 0:
                yield packed()
                found, room = [], PAIR_ROWS
        yield packed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            places = batch.column("key").to_numpy() >> half
            edges = [0, *(np.flatnonzero(places[1:] != places[:-1]) + 1).tolist(), len(places)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi > lo:
                    if places[lo] != current and held:
                        yield from close(current, held)
                        held = []
                    current = int(places[lo])
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from close(current, held)

    return _index(prints, layout, whole, similarity is not None).mapInArrow(run, "a long, b long").distinct()


def _differing(a: Column, b: Column) -> Column:
    """In how many bits two fingerprints differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _alike(pairs: DataFrame, rows: int, sets: DataFrame, similarity: float) -> tuple[DataFrame, int]:
    """The pairs (a, b), ``rows`` of them, whose sets have the similarity or more, and how many they are."""
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("a", "b"))
    one = fitted(pairs.join(left, "a"), rows, SET_ROWS)
    both = fitted(one.join(right, "b"), rows, SET_ROWS).select("a", "b", (F.size("of_a") + F.size("of_b")).alias("total"), F.size(F.array_intersect("of_a", "of_b")).alias("common"))
    good, n = counted(both.where(F.col("common") / (F.col("total") - F.col("common")) >= similarity).select("a", "b"))
    return fitted(good, n), n


def _apart(pairs: DataFrame, rows: int, parts: DataFrame) -> DataFrame:
    """The pairs, ``rows`` of them at most, whose ends lie in different components."""
    for end in ("a", "b"):
        own = parts.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = fitted(pairs.join(own, end, "left"), rows).withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.where("of_a <> of_b").drop("of_a", "of_b")


def connect(rest: DataFrame, n: int, sets: DataFrame, similarity: float, parts: DataFrame | None = None) -> DataFrame:
    """(node, component) of the texts that the ``n`` candidates (a, b, bits) join, those of ``parts`` included.

    Each round verifies every text's candidates that differ least, then leaves out what the links found so far
    join. The share verified grows each round, so a family of texts below the similarity ends too, with all its
    candidates compared.
    """
    nearest = NEAREST
    while n:
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b"), "bits"))
        ranked = both.withColumn("k", F.row_number().over(Window.partitionBy("a").orderBy("bits", "b"))).where(F.col("k") <= nearest)
        near = fitted(ranked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), 2 * n).distinct()
        chosen, n_chosen = counted(fitted(near, n))
        chosen = fitted(chosen, n_chosen)
        good, n_good = _alike(chosen, n_chosen, sets, similarity)
        rest = fitted(rest.join(chosen, ["a", "b"], "left_anti"), n)
        if n_good:
            known = good if parts is None else good.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))
            parts = connected_components(known)
            rest = _apart(rest, n, parts)
        rest, n = counted(rest)
        rest = fitted(rest, n)
        nearest *= MORE
    return sets.sparkSession.createDataFrame([], "node long, component long") if parts is None else parts


def similar_parts(keyed: DataFrame, texts: DataFrame, layout: Layout, shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of nodes with a link; ``keyed`` as from ``_printed``, ``texts`` has (row, text)."""
    prints = checkpointed(keyed.groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("fp").alias("fp")))

    def sets_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        rows = compact(prints.select("node", "row").join(wanted, "node", "left_semi"))
        return checkpointed(_sets(texts.join(rows, "row").select("node", "text"), shingle_words))

    met = compact(candidates(prints.withColumn("part", F.col("node")), layout, whole=False))
    sets = sets_of(met)
    parts = compact(connect(*_plausible(met, prints, layout), sets, similarity))
    crowd = _shared(sets.join(_crowd(met, parts), "node", "left_semi"))
    placed = prints.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).join(crowd, "node", "left")
    # the crowd as one part is not compared with itself
    found = candidates(placed.withColumn("part", F.when(F.col("shared").isNull(), F.col("part")).otherwise(CROWD_PART)), layout, whole=True)
    if not crowd.isEmpty():
        found = found.unionByName(candidates(placed.where("shared is not null"), layout, True, similarity))
    rest, n = _plausible(compact(found.join(met, ["a", "b"], "left_anti")), prints, layout)
    return connect(rest, n, sets_of(rest), similarity, parts)


def _crowd(met: DataFrame, parts: DataFrame) -> DataFrame:
    """(node) of the texts with more than CROWD candidates, of the candidates of these, and of all in a component with one."""
    both = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b")))
    many = both.groupBy("a").agg(F.count("*").alias("partners")).where(F.col("partners") > CROWD).select(F.col("a").alias("node"))
    seen = many.unionByName(both.join(many, F.col("b") == F.col("node"), "left_semi").select(F.col("a").alias("node"))).distinct()
    roots = parts.join(seen, "node", "left_semi").select("component").distinct()
    return compact(seen.unionByName(parts.join(roots, "component", "left_semi").select("node")).distinct())


def _shared(sets: DataFrame) -> DataFrame:
    """(node, shared): how many of its shingles each set has in common with any other of ``sets``, in SHARES counts."""
    rows = sets.select("node", F.explode("shingles").alias("shingle"))
    holders = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("holders"))
    place = F.col("shingle").bitwiseAND(F.lit(SHARES - 1))
    counts = lambda df: df.groupBy("node").agg(F.array(*(F.count_if(place == k).cast("int") for k in range(SHARES))).alias("counts"))
    alone = counts(holders.where("holders = 1")).withColumnRenamed("counts", "alone")
    both = counts(rows).join(alone, "node", "left")
    shared = F.when(F.col("alone").isNull(), F.col("counts")).otherwise(F.zip_with("counts", "alone", lambda a, b: a - b))
    return checkpointed(both.select("node", shared.alias("shared")))


def _plausible(pairs: DataFrame, prints: DataFrame, layout: Layout) -> tuple[DataFrame, int]:
    """(a, b, bits) of the candidates whose whole fingerprints differ in few enough bits, and how many they are."""
    ends = [prints.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("fp").alias(f"fp_{c}")) for c in ("a", "b")]
    limit = F.when(F.least("n_a", "n_b") < SMALL, layout.limits[1]).otherwise(layout.limits[0])
    both = pairs.join(ends[0], "a").join(ends[1], "b").withColumn("bits", _differing(F.col("fp_a"), F.col("fp_b")))
    good, n = counted(both.where(F.col("bits") <= limit).select("a", "b", "bits"))
    return fitted(good, n), n


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of linked texts: the one of the smallest id, null ids last.

    Words are cut at ASCII white space and A-Z lower-cased; equal words are one text, null and empty texts have
    none and are one group. Rows are chosen, not ids: null and repeated ids neither join groups nor leave one
    without a row. Texts of any length count whole. All columns are kept unchanged, whatever their names; an
    empty table gives an empty table.
    """
    rows = numbered(docs)
    layout = Layout(rows.count(), similarity)
    own, text = (F.col(f"d{docs.columns.index(c)}") for c in (id_col, text_col))
    texts = rows.select("row", own.alias("id"), text.cast("string").alias("text"))
    keyed = checkpointed(_printed(texts, layout, shingle_words))
    return drop_joined(rows, keyed.select("row", "id", "node"), similar_parts(keyed, texts.drop("id"), layout, shingle_words, similarity)).toDF(*docs.columns)
