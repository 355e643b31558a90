"""Hard-negative mining by dual-tree search.

An anchor's positives are the rows of its label with the highest inner products; the hard negatives of anchor and
positive are the highest rows of other labels whose product lies between a share of the positive's and the positive's own.

Two trees are searched together, one over anchors and one over candidates. A node has a centre, a radius and the range
of its labels. For two nodes with centres a and c and radii r and s all inner products lie in a.c -+ (|a|s + |c|r + rs):
if that interval lies outside what every anchor of the node still asks for, or the labels do not fit, the pair and all
below it is left out at once. Pairs of leaves are scored exactly. What anchors ask for narrows as they find rows.

The upper tree is Spark's. Rows are range-sorted by label and by the cell of a small tree of planes, fitted on a bounded
sample, into lanes; anchors of neighbouring lanes make groups. Lanes and groups are nodes: a row each, paired by an
equality join on the lane's number, and dropped by the same interval. Each pair left is one task's piece of work of bounded
size, in which the lower trees are built and searched. Each anchor first meets its own lane, which bounds its
positives before anything is sent. A hot label or vector runs over many lanes like all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exact_topk import EXACT, quantised
from .shared import checkpointed

POSITIVES, NEGATIVES = 5, 5
#: A negative's product is at least and at most this percentage of the positive's.
LOW_PERCENT, HIGH_PERCENT = 80, 100
#: Rows of a lane: at most on average, and at least; between them a table has LANES lanes.
LANE_ROWS, LEAST_LANE_ROWS, LANES = 32_768, 1_024, 64
#: Anchors of a group; the last lane of a group may go over it.
GROUP_ROWS, LEAST_GROUP_ROWS, GROUPS = 16_384, 256, 8
#: Rows on which the planes of the cells are fitted, and the planes that a row passes. They order the rows; results do not depend on them.
SAMPLE_ROWS, CELL_BITS = 4_096, 6
#: Rows of a leaf of the lower trees.
ANCHOR_LEAF, LEAF = 32, 128
#: Rounding of the intervals' ends, as a share of the largest product.
SLACK = 1e-9
#: No limit, where an anchor asks for scores of any size.
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

NODE = "lo long, hi long, centre array<double>, radius double"


def matrix_of(vectors: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros and longer ones cut at ``dim``, if that is given."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(vectors.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()
    if dim is None or dim == width:
        return out
    return np.pad(out, ((0, 0), (0, max(0, dim - width))))[:, :dim]


class Tree:
    """A tree of balls over rows; a node's rows are ``order[start:stop]``. Labels are told apart before places."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, leaf: int) -> None:
        self.order = np.argsort(labels, kind="stable")
        self.nodes: list[tuple[int, int, int, int]] = []  # start, stop, first child or 0, second
        centres, balls = [], []
        open_nodes = [(0, len(rows))]
        while open_nodes:
            start, stop = open_nodes.pop(0)
            at = self.order[start:stop]
            own, kinds = rows[at].astype(np.float64), labels[at]
            centre = own.mean(0)
            radius = math.sqrt(((own - centre) ** 2).sum(1).max())
            centres.append(centre)
            balls.append((radius, math.sqrt((centre**2).sum()), int(kinds.min()), int(kinds.max())))
            first = 0
            if stop - start > leaf:
                if balls[-1][2] < balls[-1][3]:
                    kinds = np.sort(kinds)
                    self.order[start:stop] = at[np.argsort(labels[at], kind="stable")]
                    edges = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
                    middle = int(edges[np.abs(edges - len(at) // 2).argmin()])
                elif own.shape[1]:
                    along = own[:, own.var(0).argmax()]
                    # the middle of the range tells groups apart; the median where it would leave a side almost empty
                    middle = int((along < (along.min() + along.max()) / 2).sum())
                    if not 0.1 <= middle / len(at) <= 0.9:
                        middle = len(at) // 2
                    self.order[start:stop] = at[np.argpartition(along, middle)]
                else:
                    middle = len(at) // 2
                first = len(self.nodes) + len(open_nodes) + 1
                open_nodes += [(start, start + middle), (start + middle, stop)]
            self.nodes.append((start, stop, first, first + 1 if first else 0))
        self.centres = np.array(centres)
        self.balls = balls
        self.rows, self.labels = rows[self.order], labels[self.order]


def dual_search(anchors: Tree, rows: Tree, same: bool, need: np.ndarray, cap: np.ndarray, score) -> int:
    """Calls ``score(anchor slice, row slice, products)`` for the pairs of leaves that anchors may ask for; the number
    of products. ``need`` and ``cap``, in the anchors' order, are what an anchor asks for; ``score`` may raise ``need``."""
    if not len(anchors.rows) or not len(rows.rows):
        return 0
    dim = min(anchors.rows.shape[1], rows.rows.shape[1])
    left, right = anchors.rows[:, :dim], rows.rows[:, :dim]
    most = max(b[0] + b[1] for b in anchors.balls) * max(b[0] + b[1] for b in rows.balls)
    if most >= 2.0**63:
        raise OverflowError("inner products of the scaled vectors may be over 64 bits")
    if most < EXACT:
        left, right = left.astype(np.float64), right.astype(np.float64)
    dots = anchors.centres[:, :dim] @ rows.centres[:, :dim].T
    count, stack = 0, [(0, 0)]
    while stack:
        a, c = stack.pop()
        start, stop, a_first, a_second = anchors.nodes[a]
        r, a_norm, a_lo, a_hi = anchors.balls[a]
        s, c_norm, c_lo, c_hi = rows.balls[c]
        if (a_hi < c_lo or c_hi < a_lo) if same else (a_lo == a_hi == c_lo == c_hi):
            continue
        wide = a_norm * s + c_norm * r + r * s + SLACK * most
        if dots[a, c] + wide < need[start:stop].min() or dots[a, c] - wide > cap[start:stop].max():
            continue
        first, last, c_first, c_second = rows.nodes[c]
        if not a_first and not c_first:
            count += (stop - start) * (last - first)
            score(slice(start, stop), slice(first, last), (left[start:stop] @ right[first:last].T).astype(np.int64))
            continue
        by_row = c_first and (not a_first or s >= r)
        pairs = [(a, c_first), (a, c_second)] if by_row else [(a_first, c), (a_second, c)]
        # the pair that may hold the higher products is searched first
        stack += sorted(pairs, key=lambda p: dots[p] + anchors.balls[p[0]][1] * rows.balls[p[1]][0] + rows.balls[p[1]][1] * anchors.balls[p[0]][0])
    return count


class Best:
    """The k highest (score, id) found so far, ties to smaller ids."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        if len(scores) > self.k:
            near = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[near], ids[near]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    @property
    def least(self) -> int:
        """A further row must reach this score."""
        return int(self.scores[-1]) if len(self.scores) == self.k else LEAST


def find_positives(anchors: dict[str, np.ndarray], rows: dict[str, np.ndarray], k: int, bounds: np.ndarray) -> tuple[list[Best], int]:
    """The k best other rows of its label of each anchor, of those that reach its bound; and the number of products."""
    a_tree, c_tree = Tree(anchors["v"], anchors["label"], ANCHOR_LEAF), Tree(rows["v"], rows["label"], LEAF)
    need, cap = bounds[a_tree.order].copy(), np.full(len(bounds), MOST)
    a_rows, c_rows, c_ids = anchors["row"][a_tree.order], rows["row"][c_tree.order], rows["id"][c_tree.order]
    best = [Best(k) for _ in range(len(bounds))]

    def score(own: slice, others: slice, products: np.ndarray) -> None:
        fits = (products >= need[own, None]) & (a_tree.labels[own, None] == c_tree.labels[others]) & (a_rows[own, None] != c_rows[others])
        for i in np.flatnonzero(fits.any(1)):
            at = own.start + i
            best[at].add(products[i, fits[i]], c_ids[others][fits[i]])
            need[at] = max(need[at], best[at].least)

    count = dual_search(a_tree, c_tree, True, need, cap, score)
    placed: list[Best] = [Best(k)] * len(best)
    for at, own in zip(a_tree.order.tolist(), best, strict=True):
        placed[at] = own
    return placed, count


def find_negatives(anchors: dict[str, np.ndarray], positives: list[np.ndarray], rows: dict[str, np.ndarray], k: int, low: int, high: int) -> tuple[list[list[Best]], int]:
    """For each anchor and each score of its positives the k best rows of other labels between ``low`` and ``high``
    percent of that score; and the number of products."""
    a_tree, c_tree = Tree(anchors["v"], anchors["label"], ANCHOR_LEAF), Tree(rows["v"], rows["label"], LEAF)
    # 100 * score within percentages of p, in whole numbers
    ranges = [[(-(-low * p // 100), high * p // 100) for p in positives[at].tolist()] for at in a_tree.order]
    need = np.array([min(r[0] for r in own) for own in ranges], np.int64)
    cap = np.array([max(r[1] for r in own) for own in ranges], np.int64)
    c_ids = rows["id"][c_tree.order]
    best = [[Best(k) for _ in own] for own in ranges]

    def score(own: slice, others: slice, products: np.ndarray) -> None:
        fits = (products >= need[own, None]) & (products <= cap[own, None]) & (a_tree.labels[own, None] != c_tree.labels[others])
        for i in np.flatnonzero(fits.any(1)):
            at = own.start + i
            scores, ids = products[i, fits[i]], c_ids[others][fits[i]]
            for found, (least, most) in zip(best[at], ranges[at], strict=True):
                inside = (scores >= max(least, found.least)) & (scores <= most)
                if inside.any():
                    found.add(scores[inside], ids[inside])
            need[at] = min(max(least, found.least) for found, (least, _) in zip(best[at], ranges[at], strict=True))

    count = dual_search(a_tree, c_tree, False, need, cap, score)
    placed: list[list[Best]] = [[]] * len(best)
    for at, own in zip(a_tree.order.tolist(), best, strict=True):
        placed[at] = own
    return placed, count


def _fields(table: pa.Table | pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in ("row", "id", "label")} | {"v": matrix_of(table.column("v"))}


def fit_planes(sample: np.ndarray, bits: int = CELL_BITS) -> list[tuple[np.ndarray, float] | None]:
    """Planes (direction, threshold) of a binary tree in heap order, each through the median of its rows' widest direction."""
    planes: list[tuple[np.ndarray, float] | None] = []
    nodes = [sample.astype(np.float64)]
    for _ in range((1 << bits) - 1):
        own = nodes.pop(0)
        if len(own) < 2 or not own.shape[1]:
            planes.append(None)
            nodes += [own, own[:0]]
            continue
        spread = own - own.mean(0)
        direction = np.linalg.svd(spread, full_matrices=False)[2][0]
        along = own @ direction
        edge = float(np.median(along))
        planes.append((direction, edge))
        nodes += [own[along < edge], own[along >= edge]]
    return planes


def cells_of(rows: np.ndarray, planes: list[tuple[np.ndarray, float] | None], bits: int = CELL_BITS) -> np.ndarray:
    """The leaf of each row in the tree of planes."""
    at = np.zeros(len(rows), np.int64)
    for _ in range(bits):
        for node in np.unique(at):
            own = np.flatnonzero(at == node)
            plane = planes[node]
            side = rows[own] @ plane[0] >= plane[1] if plane is not None else np.zeros(len(own), bool)
            at[own] = 2 * node + 1 + side
    return at - ((1 << bits) - 1)


def _laned(rows: DataFrame, n_lanes: int) -> DataFrame:
    """(lane, row, id, label, v): sorted by label and cell; a partition is a lane."""
    sample = rows.orderBy(F.xxhash64("id", "v"), "row").limit(SAMPLE_ROWS).select("v").toArrow().column("v")
    shape = matrix_of(sample)
    dim = shape.shape[1]
    planes = fit_planes(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cells_of(matrix_of(batch.column("v"), dim).astype(np.float64), planes)
            yield pa.record_batch([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    placed = rows.mapInArrow(run, "row long, id long, label long, v array<long>, cell long")
    ordered = placed.repartitionByRange(n_lanes, "label", "cell", "row").sortWithinPartitions("label", "cell", "row")
    return checkpointed(ordered.select(F.spark_partition_id().cast("long").alias("lane"), "row", "id", "label", "v"))


def _node(table: pa.Table, key: str) -> pa.Table:
    """One row: the node of the rows of a table, which have one key."""
    own, labels = matrix_of(table.column("v")).astype(np.float64), table.column("label").to_numpy()
    centre = own.mean(0)
    radius = math.sqrt(((own - centre) ** 2).sum(1).max())
    row = {key: table.column(key)[0].as_py(), "lo": int(labels.min()), "hi": int(labels.max()), "centre": centre.tolist(), "radius": radius}
    return pa.Table.from_pylist([row], pa.schema([(key, pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64())]))


def _lane(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _lane_nodes(laned: DataFrame) -> DataFrame:
    """(lane, lo, hi, centre, radius): a row a lane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (lane := _lane(batches)) is not None:
            yield from _node(lane, "lane").to_batches()

    return laned.mapInArrow(run, f"lane long, {NODE}")


def _own_anchors(laned: DataFrame, query_mod: int, k: int) -> DataFrame:
    """(lane, row, id, label, v, bound) of the anchors; a bound is the k-th best score of its label in its own lane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (lane := _lane(batches)) is None:
            return
        anchors = lane.filter(pa.array(lane.column("id").to_numpy() % query_mod == 0))
        if anchors.num_rows:
            found, _ = find_positives(_fields(anchors), _fields(lane), k, np.full(anchors.num_rows, LEAST))
            yield from anchors.append_column("bound", pa.array([b.least for b in found], pa.int64())).to_batches()

    return laned.mapInArrow(run, "lane long, row long, id long, label long, v array<long>, bound long")


def _grouped(anchors: DataFrame, n: int) -> DataFrame:
    """Anchors with their group: those of neighbouring lanes, about as many in each."""
    total = max(1, n // GROUPS)
    size = min(GROUP_ROWS, max(LEAST_GROUP_ROWS, total))
    counts = anchors.groupBy("lane").agg(F.count("*").alias("n"))
    # a row a lane
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.select("lane", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / size).alias("group"))
    return anchors.join(groups, "lane")


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda n, x: n + x)


def _pieces(anchors: DataFrame, lanes: DataFrame, n_lanes: int, same: bool) -> DataFrame:
    """(piece, group, lane): the pairs of nodes whose interval holds what an anchor of the group asks for.

    ``anchors`` has ``need`` and ``cap`` as doubles.
    """
    nodes = anchors.groupBy("group").applyInArrow(lambda t: _node(t, "group"), f"group long, {NODE}")
    asked = anchors.groupBy("group").agg(F.min("need").alias("need"), F.max("cap").alias("cap"))
    left = nodes.join(asked, "group").select("group", "need", "cap", *(F.col(c).alias(f"a_{c}") for c in ("lo", "hi", "centre", "radius")))
    both = left.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(n_lanes - 1)).cast("array<long>"))).join(lanes, "lane")
    a_norm, c_norm = (F.sqrt(_product(F.col(c), F.col(c))) for c in ("a_centre", "centre"))
    dot = _product(F.col("a_centre"), F.col("centre"))
    wide = a_norm * F.col("radius") + c_norm * F.col("a_radius") + F.col("a_radius") * F.col("radius")
    slack = SLACK * (1 + (a_norm + F.col("a_radius")) * (c_norm + F.col("radius")))
    fits = (F.col("a_lo") <= F.col("hi")) & (F.col("lo") <= F.col("a_hi")) if same else ~((F.col("a_lo") == F.col("a_hi")) & (F.col("lo") == F.col("hi")) & (F.col("a_lo") == F.col("lo")))
    inside = (dot + wide + slack >= F.col("need")) & (dot - wide - slack <= F.col("cap"))
    return both.where(fits & inside).select((F.col("lane") * F.lit(1 << 31) + F.col("group")).alias("piece"), "group", "lane")


def _met(anchors: DataFrame, laned: DataFrame, pieces: DataFrame, search, schema: str) -> DataFrame:
    """What ``search`` (anchors, rows as tables) finds in each piece."""
    left = anchors.drop("lane").join(pieces.select("group", F.col("piece").alias("of")), "group").groupBy("of")
    right = laned.join(pieces.select("lane", F.col("piece").alias("to")), "lane").groupBy("to")
    return left.cogroup(right).applyInArrow(search, schema)


def mine_hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", query_mod: int = 100, scale: int = 256,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT, counted: Accumulator | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    Components count as floor(scale * x). Anchors are the rows whose id is divisible by ``query_mod``. An anchor's
    positives are the ``positives`` best other rows of its label (all, if fewer); of each it has the ``negatives`` best
    rows (all, if fewer) of other labels whose score is between ``low`` and ``high`` percent of the positive's. Ties
    go to smaller ids.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows are told apart, not ids:
    repeated rows are candidates each, a repeated anchor is mined for each of its rows, and its copies are other rows
    of its label. Of unequal lengths, the shorter vector is filled up with zeros. Products beyond 64 bits raise an
    error. Other columns are not read; an empty table gives an empty table. ``counted`` adds up the products computed.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), quantised(F.col(vector_col), scale).alias("v"),
    ).where("id is not null and label is not null and v is not null")
    n = vectors.count()
    n_lanes = max(1, -(-n // min(LANE_ROWS, max(LEAST_LANE_ROWS, n // LANES))))
    laned = _laned(rows, n_lanes)
    n_lanes = max(1, laned.rdd.getNumPartitions())
    lanes = checkpointed(_lane_nodes(laned))
    anchors = checkpointed(_own_anchors(laned, query_mod, positives))
    anchors = checkpointed(_grouped(anchors, anchors.count()))

    def add(products: int) -> None:
        if counted is not None:
            counted.add(products)

    def best_positives(own: pa.Table, others: pa.Table) -> pa.Table:
        a, c = _fields(own), _fields(others)
        found, products = find_positives(a, c, positives, own.column("bound").to_numpy())
        add(products)
        sizes = [len(b.ids) for b in found]
        return pa.table({
            "row": np.repeat(a["row"], sizes),
            "positive_id": np.concatenate([b.ids for b in found]), "positive_score": np.concatenate([b.scores for b in found]),
        })

    asked = anchors.select("*", F.col("bound").cast("double").alias("need"), F.lit(float("inf")).alias("cap"))
    pieces = checkpointed(_pieces(asked, lanes, n_lanes, same=True))
    near = _met(anchors, laned, pieces, best_positives, "row long, positive_id long, positive_score long")
    ranked = near.withColumn("k", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id"))).where(F.col("k") <= positives)
    held = ranked.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "positive_id", "positive_score"))).alias("held"))
    with_held = checkpointed(anchors.drop("bound").join(held, "row").select("*", F.col("held.positive_id").alias("positive_ids"), F.col("held.positive_score").alias("positive_scores")).drop("held"))

    def best_negatives(own: pa.Table, others: pa.Table) -> pa.Table:
        a = _fields(own)
        scores = [np.array(s, np.int64) for s in own.column("positive_scores").to_pylist()]
        ids = own.column("positive_ids").to_pylist()
        found, products = find_negatives(a, scores, _fields(others), negatives, low, high)
        add(products)
        rows = [(at, k, b) for at, bests in enumerate(found) for k, b in enumerate(bests) if len(b.ids)]
        sizes = [len(b.ids) for _, _, b in rows]
        spread = lambda values: np.repeat(np.array(values, np.int64), sizes)
        joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        return pa.table({
            "row": spread([a["row"][at] for at, _, _ in rows]), "anchor_id": spread([a["id"][at] for at, _, _ in rows]), "k": spread([k for _, k, _ in rows]),
            "positive_id": spread([ids[at][k] for at, k, _ in rows]), "positive_score": spread([scores[at][k] for at, k, _ in rows]),
            "negative_id": joined([b.ids for _, _, b in rows]), "negative_score": joined([b.scores for _, _, b in rows]),
        })

    asked = with_held.select("*", (F.array_min("positive_scores") * (low / 100)).alias("least"), (F.array_max("positive_scores") * (high / 100)).alias("most"))
    # of negative scores the smaller share is the greater number
    asked = asked.select("*", F.least("least", F.array_max("positive_scores") * (low / 100)).alias("need"), F.greatest("most", F.array_min("positive_scores") * (high / 100)).alias("cap"))
    pieces = checkpointed(_pieces(asked, lanes, n_lanes, same=False))
    found = _met(with_held, laned, pieces, best_negatives, "row long, anchor_id long, k long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "k").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def contract_labels(vectors: DataFrame) -> DataFrame:
    """``vectors`` with the label (label + 1) % 10 where vec_id is divisible by 7."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
