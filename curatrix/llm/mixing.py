"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Targets: sources, in order of code point and null last, weigh 5, 2, 1 and again 5, 2, 1, and share the
words of all documents by weight. A source gives its words ``max_epochs`` times at most; what it cannot
give is shared again by weight. That is a water level: each source's target is the lesser of its
capacity and its weight times one level, found from the sources sorted by capacity over weight.

Curriculum: over training time 0 to 1 a source's weight runs in a straight line from ``start`` to
``end`` of its phase. The integral of the schedule, scaled to the target, is the source's cumulative
demand. Its documents, in the order of a hash, are laid end to end, epoch after epoch, and the demand
inverted at the middle of a document gives its training position. Documents are range-sorted by it.

A source may hold any share of the rows: running sums go by (source, first digits of the hash), and
only the sums of these chunks, 4096 a source at most, are summed up in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: How often a document is taken at most.
MAX_EPOCHS = 3
#: (start, end) of the schedules of the sources in order, repeating: fading, even, rising.
PHASES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: Hexadecimal digits of the hash that make a chunk.
CHUNK_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From (source, size) rows: source, place (from 0), weight, source_size, target.

    One row a source; the table of sources, not of documents, is ranked and summed in order.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    ranked = totals.withColumn("place", place).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("capacity", F.col("source_size") * max_epochs).withColumn("ratio", F.col("capacity") / F.col("weight"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("spent", F.coalesce(F.sum("capacity").over(upto), F.lit(0))).withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    # the level if this source and all of greater ratio stay under their capacity; the first that does sets it
    ranked = ranked.withColumn("level", (F.sum("source_size").over(everything) - F.col("spent")) / F.col("rest"))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)["level"]
    target = F.least(F.col("capacity").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return ranked.select("source", "place", "weight", "source_size", target.alias("target"))


def time_of(share: Column, start: Column, end: Column) -> Column:
    """The time at which a schedule from ``start`` to ``end`` has met ``share`` of its demand."""
    area = share * (start + end) / 2
    slope = end - start
    return F.when(slope == 0, share).otherwise((F.sqrt(F.greatest(F.lit(0.0), start * start + 2 * slope * area)) - start) / slope)


def curriculum_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", whole: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per document: id_col, source_col, size (words), source_size, target (the source's, in words),
    taken (words the mix takes of the document, repeats counted), positions (array of times from 0 to 1,
    one a copy, in order), then the columns ``keep`` of ``docs``.

    A source's taken words are its target rounded to a whole word: full epochs, then the documents first
    in hash order, the last of them in part. With ``whole`` that last one is taken whole if at least half
    of it is asked for, else not at all. Null and empty texts have size 0 and are never taken; a source of
    size 0 has target 0. Null sources are one source, the last. Rows that repeat an id are documents of
    their own; their order in ties does not change the sums. An empty table gives an empty table.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    extra = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep or [])]
    rows = checkpointed(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), digest.alias("digest"), *extra))
    # one key without nulls for window and join, so that the rows are shuffled by it once
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    rows = rows.withColumn("chunk", F.substring("digest", 1, CHUNK_DIGITS)).withColumn("cell", F.concat("chunk", name))
    chunks = rows.groupBy("source", "chunk", "cell").agg(F.sum("size").alias("size"))
    targets = source_targets(chunks.select("source", "size")).withColumnRenamed("source", "of")
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select("source", "cell", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets, F.col("source").eqNullSafe(F.col("of"))).select("cell", "offset", "place", "source_size", "target")
    inside = Window.partitionBy("cell").orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    laid = summed.join(offsets, "cell").withColumn("start", F.col("offset") + F.col("inside"))
    asked = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(asked / F.col("source_size"))).otherwise(0).cast("long")
    laid = laid.withColumn("asked", asked).withColumn("epochs", epochs)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("asked") - F.col("epochs") * F.col("source_size") - F.col("start")))
    if whole:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    laid = laid.withColumn("part", part.cast("long"))
    copies = F.col("epochs").cast("int") + F.when(F.col("part") > 0, 1).otherwise(0)
    phase = (F.col("place") % len(PHASES) + 1).cast("int")
    begin, end = (F.element_at(F.array(*(F.lit(p[k]) for p in PHASES)), phase) for k in (0, 1))
    middle = lambda epoch: epoch * F.col("source_size") + F.col("start") + F.col("size") / 2
    times = F.transform(F.sequence(F.lit(0), copies - 1), lambda e: time_of(F.least(F.lit(1.0), middle(e) / F.col("target")), begin, end))
    positions = F.when((copies > 0) & (F.col("size") > 0), times).otherwise(F.array().cast("array<double>"))
    return laid.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), positions.alias("positions"), *(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep or [])))


def in_training_order(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The plan with its first position as ``position``, range-sorted by it; documents not taken come last."""
    return plan.withColumn("position", F.get("positions", F.lit(0))).orderBy(F.asc_nulls_last("position"), id_col)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it is taken, range-sorted by position.

    Whole documents are taken, so a source misses its target by half a document at most. The columns
    are those of ``docs``; documents not taken, those without words among them, are left out.
    """
    rest = [c for c in docs.columns if c not in (id_col, source_col)]
    plan = curriculum_plan(docs, id_col, text_col, source_col, whole=True, keep=rest)
    # by place, as columns of docs may bear the plan's names
    names = [f"m{k}" for k in range(len(plan.columns))]
    copies = plan.toDF(*names).withColumn("at", F.explode("m6")).orderBy("at", "m0")
    where = {id_col: "m0", source_col: "m1"} | {c: f"m{7 + k}" for k, c in enumerate(rest)}
    return copies.select(*(F.col(where[c]).alias(c) for c in docs.columns))
