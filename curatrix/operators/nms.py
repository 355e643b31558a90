"""Post-processing of detections: confidence filter, class-aware suppression, matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box, iou
from ..session import checkpointed
from .grid import in_cells

#: Detections of one frame and class that are folded in one row at most.
FOLD_BOXES = 4_096
DETECTION = ["pos", "class_id", "confidence", "x1", "y1", "x2", "y2"]


def _overlap(a: Column, b: Column) -> Column:
    return iou(Box(a["x1"], a["y1"], a["x2"], a["y2"]), Box(b["x1"], b["y1"], b["x2"], b["y2"]))


def survivors(detections: Column, iou_threshold: float) -> Column:
    """Greedy suppression of an array of detections: by falling confidence, ties in order of ``pos``; one is
    dropped if a kept one of its class overlaps it by more than the threshold."""
    order = F.array_sort(F.transform(detections, lambda d: F.struct((-d["confidence"]).alias("rank"), d["pos"].alias("pos"), d.alias("d"))))
    ranked = F.transform(order, lambda s: s["d"])
    empty = F.slice(ranked, 1, 0)
    return F.aggregate(ranked, empty, lambda kept, d: F.when(F.exists(kept, lambda k: (k["class_id"] == d["class_id"]) & (_overlap(k, d) > iou_threshold)), kept).otherwise(F.concat(kept, F.array(d))))


def suppress(detections: DataFrame, frame: str, confidence: float = 0.25, iou_threshold: float = 0.5, mode: str = "class_aware", fold_boxes: int = FOLD_BOXES) -> DataFrame:
    """Detections (frame, *DETECTION) that survive, with ``rank`` from 0 in their frame.

    Confidence counts from the threshold on. Mode ``none`` keeps all others in order of pos. Up to ``fold_boxes``
    detections of a frame and class are folded in one row; more go through ``suppress_in_rounds``, with the
    same result. A stream is folded, as a detector bounds its frames.
    """
    kept = detections.where(F.col("confidence") >= confidence)
    if mode == "none":
        return kept.select(frame, *DETECTION, (F.row_number().over(Window.partitionBy(frame).orderBy("pos")) - 1).alias("rank"))
    if mode != "class_aware":
        raise ValueError("mode is class_aware or none")
    # only classes of one frame meet, so each is folded for itself
    def folded(rows: DataFrame) -> DataFrame:
        packed = rows.groupBy(frame, "class_id").agg(F.collect_list(F.struct(*DETECTION)).alias("all"))
        return packed.select(frame, F.explode(survivors(F.col("all"), iou_threshold)).alias("d")).select(frame, "d.*")

    large = None if kept.isStreaming else checkpointed(kept.groupBy(frame, "class_id").agg(F.count("*").alias("_n")).where(F.col("_n") > fold_boxes))
    if large is None or large.isEmpty():
        rows = folded(kept)
    else:
        same = kept[frame].eqNullSafe(large[frame]) & kept["class_id"].eqNullSafe(large["class_id"])
        many, _ = suppress_in_rounds(kept.join(large, same, "left_semi"), frame, iou_threshold)
        rows = folded(kept.join(large, same, "left_anti")).unionByName(many)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(frame).orderBy(F.desc("confidence"), "pos")) - 1)


def suppress_in_rounds(detections: DataFrame, frame: str, iou_threshold: float) -> tuple[DataFrame, int]:
    """(survivors (frame, *DETECTION), rounds): the greedy suppression of each frame and class, however many they hold.

    Boxes lie in the cells of ``grid.in_cells``, where every pair meets that could suppress. In each round a box that ranks
    first in all its cells is kept, as nothing live can suppress it, and what it overlaps by more than the threshold goes.
    A cell has one first box, so a round compares as many pairs as there are rows, in a heap of
    boxes too; the first box of all is always kept, so rounds end. Each is a few joins by cell.
    """
    rows = checkpointed(detections.select(frame, *DETECTION, F.monotonically_increasing_id().alias("_row")))
    cells = in_cells(rows, [frame, "class_id"], max(0.0, iou_threshold))
    order = F.struct((-F.col("confidence")).alias("c"), F.col("pos").alias("p"), F.col("_row").alias("row"))
    place = F.struct(frame, "class_id", "_cell")
    live = checkpointed(cells.select(place.alias("_place"), "_row", "_cells", order.alias("_order"), F.struct("x1", "y1", "x2", "y2").alias("_box")))
    # boxes without an area suppress nothing and are not suppressed
    kept = [rows.select("_row").join(live, "_row", "left_anti")]
    rounds = 0
    while not live.isEmpty():
        rounds += 1
        first = live.groupBy("_place").agg(F.min_by(F.struct("_row", "_cells", "_box"), "_order").alias("_first"))
        first = checkpointed(first)
        won = first.groupBy("_first._row").agg(F.count("*").alias("_n"), F.first("_first._cells").alias("_cells")).where("_n = _cells").select("_row")
        won = checkpointed(won)
        kept.append(won)
        by = first.select("_place", F.col("_first._row").alias("_by"), F.col("_first._box").alias("_over")).join(won.select(F.col("_row").alias("_by")), "_by", "left_semi")
        gone = live.join(by, "_place").where((F.col("_row") == F.col("_by")) | (_overlap(F.col("_over"), F.col("_box")) > iou_threshold)).select("_row").distinct()
        live = checkpointed(live.join(gone, "_row", "left_anti"))
    # each round's table is a branch of this union
    return rows.join(reduce(DataFrame.unionByName, kept), "_row", "left_semi").drop("_row"), rounds


def greedy_matches(references: DataFrame, decoded: DataFrame, frame: str, accept: float = 0.5, top: int = 20) -> DataFrame:
    """(frame, ref_pos, pos, iou): the ``top`` references of a frame, by falling score, each take the best unused
    decoded row of their class among the ``top`` decoded ones, if it overlaps by ``accept`` or more.

    A strictly greater overlap wins; among equal ones the first in rank does.
    """

    def ranked(df: DataFrame) -> DataFrame:
        order = Window.partitionBy(frame).orderBy(F.desc("confidence"), "pos")
        best = df.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top)
        return best.groupBy(frame).agg(F.array_sort(F.collect_list(F.struct("k", *DETECTION))).alias("rows"))

    both = ranked(references).withColumnRenamed("rows", "refs").join(ranked(decoded), frame)
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<struct<ref_pos:long,pos:long,iou:double>>").alias("out"))

    def take(state: Column, ref: Column) -> Column:
        free = F.filter(F.col("rows"), lambda d: (d["class_id"] == ref["class_id"]) & ~F.array_contains(state["used"], d["k"]))
        scored = F.transform(free, lambda d: F.struct((-_overlap(ref, d)).alias("o"), d["k"].alias("k"), d["pos"].cast("long").alias("pos")))
        best = F.array_min(scored)
        hit = F.struct(F.concat(state["used"], F.array(best["k"])).alias("used"), F.concat(state["out"], F.array(F.struct(ref["pos"].cast("long").alias("ref_pos"), best["pos"].alias("pos"), (-best["o"]).alias("iou")))).alias("out"))
        return F.when(best.isNotNull() & (-best["o"] >= accept), hit).otherwise(state)

    found = both.withColumn("found", F.aggregate("refs", start, take, lambda s: s["out"]))
    return found.select(frame, F.inline("found"))


def nearest_matches(references: DataFrame, decoded: DataFrame, keys: list[str], frame: str, top: int = 20) -> DataFrame:
    """Each of the ``top`` decoded rows of a frame with the greatest overlap and the least largest side difference over
    those of the frame's ``top`` references that have its ``keys`` (frame and class); null where there is none. Rows
    rank by falling confidence, then pos."""
    a, b = Box.named("r_"), Box.named("")
    best = lambda df: df.withColumn("_k", F.row_number().over(Window.partitionBy(frame).orderBy(F.desc("confidence"), "pos"))).where(F.col("_k") <= top).drop("_k")
    refs = best(references).select(*keys, *(F.col(c).alias(f"r_{c}") for c in ("x1", "y1", "x2", "y2")))
    delta = F.greatest(*(F.abs(r - d) for r, d in zip(a.sides, b.sides, strict=True)))
    pairs = best(decoded).join(refs, keys, "left").withColumn("o", F.when(F.col("r_x1").isNotNull(), iou(a, b))).withColumn("delta", delta)
    return pairs.groupBy(*keys, "pos").agg(F.max("o").alias("best_iou"), F.min("delta").alias("least_delta"))
