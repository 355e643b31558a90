"""Ingest of image annotations in the common three-array form into a released data set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.strings import numbered
from ..operators import dedup, findings
from ..operators.split import assign_splits
from ..session import checkpointed
from ..sources.large_json import RANGE_BYTES, array_parts
from . import preflight

#: The arrays of a source, and what is read of their elements.
SOURCE = {
    "images": "id long, file_name string, width long, height long, license string, flickr_url string, coco_url string",
    "annotations": "id long, image_id long, category_id long, bbox array<double>",
    "categories": "id long, name string",
}


@dataclass
class Source:
    images: DataFrame
    annotations: DataFrame
    categories: DataFrame


def read_source(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> Source:
    """The three arrays of the annotation documents under ``path``, however large: many tasks read one document.

    Raises for a document without one of the arrays, or with one twice, for one that is no whole JSON, and for
    elements that are not of the form of their array.
    """
    parts = checkpointed(array_parts(spark, path, list(SOURCE), range_bytes))
    begun = parts.where("text is null").groupBy("path").agg(*(F.count_if(F.col("name") == name).alias(name) for name in SOURCE))
    files = spark.read.format("binaryFile").load(path).select("path")
    wrong = files.join(begun, "path", "left").where(" or ".join(f"{name} is null or {name} <> 1" for name in SOURCE))
    if not wrong.isEmpty():
        raise ValueError(f"images, annotations and categories arrays are needed, once each: {[r.path for r in wrong.limit(5).collect()]}")
    tables = []
    for name, fields in SOURCE.items():
        columns = [x.split(" ")[0] for x in fields.split(", ")]
        kind = f"struct<{', '.join(x.replace(' ', ': ', 1) for x in fields.split(', '))}, _corrupt: string>"
        element = F.from_json("text", f"{fields}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
        wrong = F.raise_error(F.concat(F.lit(f"an element of {name} is not of the form of its array: "), F.substring("text", 1, 200))).cast(kind)
        # other rows are named too: a filter may be moved behind this
        own = (F.col("name") == name) & F.col("text").isNotNull()
        # a column of its own: the judgement and what is read would each parse the text
        read = parts.where(own).select("name", "text", element.alias("e"))
        judged = F.when(~own, F.lit(None).cast(kind)).when(F.col("e._corrupt").isNull() & F.startswith("text", F.lit("{")), F.col("e")).otherwise(wrong)
        tables.append(read.select(judged.alias("e")).select(*(F.col(f"e.{c}") for c in columns)))
    return Source(*tables)


def mapping_tables(spark: SparkSession, categories: dict[str, str], ignore: list[str], classes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(mapping, ignored) of an ontology configuration: category names to class ids, and names left out.

    Raises if a name is mapped to an unknown class, or both mapped and ignored.
    """
    unknown = sorted(set(categories.values()) - set(classes))
    if unknown or set(categories) & set(ignore):
        raise ValueError(f"unknown classes {unknown}, or names both mapped and ignored")
    return spark.createDataFrame(list(categories.items()), "name string, class_id string"), spark.createDataFrame([(x,) for x in ignore], "name string")


def unmapped_categories(categories: DataFrame, mapping: DataFrame, ignored: DataFrame) -> DataFrame:
    return categories.select("name").distinct().join(mapping, "name", "left_anti").join(ignored, "name", "left_anti")


def outcomes(images: DataFrame, decoded: DataFrame) -> DataFrame:
    """Every image with what became of it: ``reason`` is null for those kept.

    ``decoded`` (file_name, ok, oriented, sha256, width, height, h) has a row per file found. An image
    has one outcome, the first of missing_source, decode_failed, exif_orientation, duplicate_image; of
    equal images the first id stays, and only usable ones count as seen.
    """
    rows = images.select("id", "file_name").join(decoded, "file_name", "left")
    early = F.when(F.col("ok").isNull(), "missing_source").when(~F.col("ok"), "decode_failed").when(F.col("oriented"), "exif_orientation")
    rows = rows.withColumn("early", early)
    # only usable images compete; a row that is out already belongs to no group, so that none of these is large
    usable = rows.where("early is null")
    first = usable.groupBy("sha256").agg(F.min("id").alias("first"))
    judged = usable.join(first.withColumnRenamed("sha256", "of"), F.col("sha256").eqNullSafe(F.col("of"))).drop("of")
    judged = judged.withColumn("reason", F.when(F.col("id") != F.col("first"), "duplicate_image")).drop("first")
    return judged.unionByName(rows.where("early is not null").withColumn("reason", F.col("early"))).drop("early", "ok", "oriented")


def converted_objects(annotations: DataFrame, kept: DataFrame, categories: DataFrame, mapping: DataFrame, ignored: DataFrame) -> DataFrame:
    """Objects of kept images: image_id, id, class_id, bbox, dropped (why it was left out, else null).

    ``kept`` has id, scale, width and height of the canonical image. Objects number from 0 in order of
    annotation id, those left out not counted.
    """
    named = annotations.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id").join(mapping, "name", "left")
    left_out = ignored.select("name").distinct().withColumn("is_ignored", F.lit(True))
    rows = named.join(left_out, "name", "left").withColumnRenamed("id", "annotation_id").join(kept.select(F.col("id").alias("image_id"), "scale", "width", "height"), "image_id")
    sides = [F.get("bbox", F.lit(k)) for k in range(4)]
    box = geometry.representable(*sides, F.col("scale"), F.col("width"), F.col("height"))
    judged = rows.withColumn("box", box).withColumn("dropped", F.when(F.col("is_ignored"), "ignored_category").when(F.col("box").isNull(), "unrepresentable_box"))
    rank = F.row_number().over(Window.partitionBy("image_id", F.col("dropped").isNull()).orderBy("annotation_id")) - 1
    return judged.select("image_id", "annotation_id", F.when(F.col("dropped").isNull(), numbered("object-", 4, rank)).alias("id"), "class_id", F.col("box").alias("bbox"), "dropped")


@dataclass
class Ingested:
    """items and objects of the data set, and reports: outcomes of images, objects left out."""

    items: DataFrame
    objects: DataFrame
    skipped: DataFrame
    dropped: DataFrame


def ingest(source: Source, decoded: DataFrame, mapping: DataFrame, ignored: DataFrame, dataset_id: str, seed: int = 42, train_fraction: float = 0.8, longest_side: int = 1280, most_unusable: float = 0.05, near_bits: int = dedup.NEAR_BITS) -> Ingested:
    """The data set: exact duplicates left out, near ones grouped, groups split, objects converted.

    ``decoded`` gives the canonical image's hash and size, and its average hash ``h``. Raises for categories
    that are neither mapped nor ignored, and for too many unusable images.
    """
    lost = unmapped_categories(source.categories, mapping, ignored)
    if not lost.isEmpty():
        raise ValueError(f"categories without a class: {[r.name for r in lost.orderBy('name').limit(20).collect()]}")
    ends = checkpointed(outcomes(source.images, decoded))
    preflight.check_unusable(ends, most_unusable)
    scale, width, height = geometry.downscaled(F.col("source_width"), F.col("source_height"), longest_side)
    sizes = source.images.select("id", F.col("width").alias("source_width"), F.col("height").alias("source_height"))
    kept = ends.where("reason is null").select("id", "file_name", "sha256", "h").join(sizes, "id").select("id", "file_name", "sha256", "h", scale.alias("scale"), width.alias("width"), height.alias("height"))
    item = numbered(f"{dataset_id}-", 12, F.col("id"))
    named = checkpointed(kept.withColumn("item_id", item))
    objects = checkpointed(converted_objects(source.annotations, named, source.categories, mapping, ignored))
    good = objects.where("dropped is null").drop("dropped")
    groups = checkpointed(dedup.duplicate_groups(named.select(F.col("item_id").alias("id"), "sha256", "h"), near_bits))
    grouped = named.join(groups.withColumnRenamed("id", "item_id"), "item_id")
    classes = good.join(grouped.select(F.col("id").alias("image_id"), "group_id"), "image_id").select("group_id", "class_id")
    splits = assign_splits(grouped.select("group_id"), classes, dataset_id, seed, train_fraction)
    items = grouped.join(splits, "group_id").select(F.col("id").alias("image_id"), "item_id", "file_name", "sha256", "scale", "width", "height", "group_id", "split")
    return Ingested(items, good, preflight.skip_counts(ends), objects.where("dropped is not null").groupBy("dropped").agg(F.count("*").alias("n")))


def annotation_documents(ingested: Ingested, dataset_id: str, ontology_id: str, ontology_version: str, actor: str, run: str, tool: str, created_at: str) -> DataFrame:
    """(image_id, doc): the approved annotation of each item; images without objects have an empty list."""
    packed = ingested.objects.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("id", "class_id", "bbox"))).alias("objects"))
    rows = ingested.items.join(packed, "image_id", "left")
    text = lambda value, name: F.lit(value).alias(name)
    none = F.array().cast("array<struct<id:string,class_id:string,bbox:array<double>>>")
    doc = F.struct(
        text("1.0.0", "schema_version"), numbered(f"{dataset_id}-approved-", 12, F.col("image_id")).alias("id"), F.col("item_id"), F.col("sha256").alias("image_sha256"), text(ontology_id, "ontology_id"), text(ontology_version, "ontology_version"), text(created_at, "created_at"), text("approved", "status"),
        F.struct(text("human", "kind"), text(actor, "actor_id"), text(run, "run_id"), text(tool, "tool_version")).alias("source"),
        F.struct(text(actor, "reviewer_id"), text(created_at, "reviewed_at"), text("taken over as published", "reason")).alias("review"),
        F.coalesce("objects", none).alias("objects"),
    )
    return rows.select("image_id", doc.alias("doc"))


def group_sizes(items: DataFrame) -> DataFrame:
    """One row: how many groups items have, and how many of them hold more than one image."""
    sizes = items.groupBy("group_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("total"), F.count_if(F.col("n") > 1).alias("multi_image"))


def report(ingested: Ingested) -> dict[str, DataFrame]:
    """The tables of an ingest report: splits, totals, multi-image groups, skipped images, dropped objects."""
    boxes = ingested.objects.select("image_id", "class_id", *(F.get("bbox", F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))
    return {
        "splits": preflight.distribution(ingested.items, boxes),
        "totals": preflight.totals(ingested.items, boxes),
        "groups": group_sizes(ingested.items),
        "skipped": ingested.skipped,
        "dropped": ingested.dropped,
    }


def released_findings(items: DataFrame) -> DataFrame:
    """What a manifest of these items must not break: unique ids and hashes, groups within one split."""
    rows = items.select(F.lit("dataset").alias("document"), F.col("image_id").alias("pos"), F.col("item_id"), "sha256", "group_id", "split", F.concat(F.lit("/items/"), F.col("item_id")).alias("field"))
    return findings.all_findings(findings.duplicate_values(rows.withColumn("value", F.col("item_id")), "item id"), findings.duplicate_values(rows.withColumn("value", F.col("sha256")), "image hash"), findings.split_leaks(rows))
