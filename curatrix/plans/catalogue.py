"""The operators applied to the test tables.

The tables hold no images or annotations, so they stand in for them, under these proxies: *items* are
``documents`` (the text is the image's bytes), *objects* are ``lineitem`` rows on a canvas of 100 x 80
for each order, *frames* are ``events``, *thumbnails* are ``embeddings`` (64 values), *revisions* are
the turns of ``conversations`` and *review states* are ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, strings
from ..functions.geometry import Box
from ..functions.hashes import average_hash
from ..operators import dedup, findings, grid, lineage, nms, quantiles, revisions, split
from ..session import checkpointed
from . import preflight, validation

WIDTH, HEIGHT = 100.0, 80.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, pos, class_id, confidence, x1, y1, x2, y2."""
    # named first: a window's partitions are known by the name that it was given, and steps by image then need no shuffle
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "image_id")
    order = Window.partitionBy("image_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    across = F.col("l_quantity") + (F.col("l_partkey") % 60) - 1
    down = F.col("l_linenumber") * F.lit(8.0)
    return lines.select("image_id", F.row_number().over(order).alias("pos"), F.col("l_returnflag").alias("class_id"), (F.col("l_discount") * 10).alias("confidence"), F.col("l_quantity").alias("x1"), down.alias("y1"), across.alias("x2"), (down + (F.col("l_suppkey") % 40) - 1).alias("y2"))


def valid_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = geometry.box_rules(Box.named(), F.lit(WIDTH), F.lit(HEIGHT))
    return objects(spark, sf_dir).where(F.size(rules) == 0)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, image_sha256, group_id, split."""
    digit = F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 1)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.sha2("text", 256).alias("image_sha256"), F.concat("source", F.lit("-"), "lang").alias("group_id"), F.when(digit < "c", "train").otherwise("validation").alias("split"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, split of every order, those without lines being negatives."""
    digit = F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 1)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), F.when(digit < "c", "train").otherwise("validation").alias("split"), F.col("o_custkey").cast("string").alias("group_id"))


def thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, h: the average hash of each thumbnail."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", average_hash(F.col("embedding")).alias("h"))


def revision_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, supersedes: the turns of a conversation, the one before being superseded."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string"))
    previous = F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.select(name(F.col("turn")).alias("id"), F.when(previous.isNotNull(), name(previous)).alias("supersedes"))


def q1_split_class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = preflight.distribution(order_items(spark, sf_dir), objects(spark, sf_dir))
    return report.select("split", F.coalesce("class_id", F.lit("*")).alias("class_id"), "images", "objects", "negative_images")


def q2_duplicate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).select(F.lit("items").alias("document"), "item_id", F.col("image_sha256").alias("value"))
    return findings.repeats(rows, ["document"], "value", ["item_id"]).select("item_id", F.col("value").alias("image_sha256"), "occurrence")


def q3_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    dated = lines.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    late = dated.where(strings.out_of_order(stamp("o_orderdate"), stamp("l_shipdate")))
    return late.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def q4_frame_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames in order of event, then the same frames in an order shuffled by a hash, which must break."""
    frames = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.sha2(F.col("event_id").cast("string"), 256).alias("mixed"))
    out = []
    for name, order in (("arrival", ["event_id"]), ("mixed", ["mixed", "event_id"])):
        breaks = findings.frame_order_breaks(frames, ["event_type", "user_id"], order, "event_id")
        out.append(breaks.select(F.lit(name).alias("ordering"), "event_type", "user_id", "event_id", F.col("previous").alias("previous_id")))
    return out[0].unionByName(out[1])


def q5_split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = findings.previous_of(items(spark, sf_dir), ["group_id"], ["item_id"], "split")
    return rows.where(F.col("previous") != F.col("split")).select("item_id", "group_id", "split", F.col("previous").alias("previous_split"))


def q6_average_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thumbnails(spark, sf_dir).select("vec_id", "h")


def q7_hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.hash_pairs(thumbnails(spark, sf_dir).select("h"), bits=20)


def q8_box_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = geometry.box_rules(Box.named(), F.lit(WIDTH), F.lit(HEIGHT))
    return objects(spark, sf_dir).select("image_id", "pos", F.explode(rules).alias("rule"))


def q9_scaled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corner and size scaled by 0.8 into a frame of 80 x 64; null where not representable."""
    rows = objects(spark, sf_dir)
    box = geometry.representable(F.col("x1") - 2, F.col("y1") - 8.3, F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(0.8), F.lit(80.0), F.lit(64.0))
    return rows.withColumn("box", box).select("image_id", "pos", F.col("box").isNotNull().alias("kept"), *(F.round(F.get("box", F.lit(k)), 6).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))


def q10_normalised_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = geometry.normalised(Box.named(), F.lit(WIDTH), F.lit(HEIGHT))
    return valid_objects(spark, sf_dir).select("image_id", "pos", *(F.round(s, 9).alias(c) for s, c in zip(shares, ("cx", "cy", "w", "h"), strict=True)))


def q11_pairwise_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_objects(spark, sf_dir).drop("confidence")
    pairs = grid.overlapping(rows, rows, ["image_id", "class_id"]).where("a.pos < b.pos").withColumn("iou", F.round("iou", 9))
    return pairs.where("iou > 0").select("image_id", "class_id", "a.pos", F.col("b.pos").alias("other_pos"), "iou")


def q12_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = nms.suppress(valid_objects(spark, sf_dir), "image_id", confidence=0.25, iou_threshold=0.3)
    return kept.select("image_id", "pos", "class_id", "confidence", "rank")


def q13_groups_and_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near thumbnails (20 bits, as none are nearer than 15 here), split with all labels covered. Many
    thumbnails are all one group, which then validates."""
    hashes = thumbnails(spark, sf_dir)
    rows = hashes.select(F.format_string("%06d", "vec_id").alias("id"), F.format_string("%06d", "vec_id").alias("sha256"), "h", F.col("label").alias("class_id"))
    groups = dedup.duplicate_groups(rows.select("id", "sha256", "h"), bits=20)
    classes = groups.join(rows.select("id", "class_id"), "id").select("group_id", "class_id")
    splits = split.assign_splits(groups.select("group_id"), classes, "thumbnails", 42, 0.8, least_groups=1)
    return groups.join(splits, "group_id").select("id", "group_id", "split")


def q14_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of a preflight; the ontology declares one class that nothing has."""
    ontology = spark.createDataFrame([("A",), ("N",), ("R",), ("Z",)], "class_id string")
    report = preflight.preflight_findings(order_items(spark, sf_dir), objects(spark, sf_dir), ontology)
    return report.select("severity", "rule", F.coalesce("class_id", F.lit("")).alias("class_id"))


def q15_open_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number of an open JSON object, checked to be finite and in range."""
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "double")
    rows = table(spark, sf_dir, "events").select("event_id", value.alias("k"))
    return rows.select("event_id", F.col("k").cast("long").alias("k"), (geometry.is_finite(F.col("k")) & (F.col("k") >= 50)).alias("high"))


def q16_clean_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("path"))
    return urls.select("page_id", strings.is_clean_path(F.col("path")).alias("clean"), F.rlike("path", F.lit(strings.SCHEMA_PATH)).alias("schema_path"), strings.suffix_of(F.regexp_extract("path", "^[^?#]*", 0)).alias("suffix"))


def q17_revision_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisions.walk_chains(revision_rows(spark, sf_dir))


def q18_lineage_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, whether the suppliers of its first lines are those of all its lines."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.sha2(F.col("l_suppkey").cast("string"), 256).alias("sha256"))
    sides = rows.withColumn("side", F.lit("inputs")).unionByName(rows.where("l_linenumber <= 3").withColumn("side", F.lit("outputs")))
    return lineage.unequal_sets(sides, "l_orderkey")


def q19_best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's orders the first of greatest priced, prices rounded so that ties occur."""
    rows = table(spark, sf_dir, "orders").withColumn("price", F.floor(F.col("o_totalprice") / 50000))
    return lineage.best_row(rows, ["o_custkey"], "price", ["o_orderkey"]).select("o_custkey", "o_orderkey", F.col("price").cast("long").alias("price"))


def q20_nearest_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd objects against even ones of their image and class: best overlap and least side difference."""
    rows = valid_objects(spark, sf_dir)
    found = nms.nearest_matches(rows.where("pos % 2 = 0"), rows.where("pos % 2 = 1"), ["image_id", "class_id"], "image_id")
    found = checkpointed(found)
    middle = quantiles.medians(found, ["class_id"], ["best_iou", "least_delta"]).select("class_id", F.round("best_iou", 6).alias("median_iou"), F.round("least_delta", 6).alias("median_delta"))
    summary = found.groupBy("class_id").agg(F.count("*").alias("n"), F.count("best_iou").alias("matched"), F.round(F.max("best_iou"), 6).alias("greatest_iou"))
    return summary.join(middle, "class_id")


def q21_mapping_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types that a mapping, of the smallest parts of one brand, does not classify."""
    kinds = table(spark, sf_dir, "part").select(F.col("p_type").alias("value")).distinct().withColumn("document", F.lit("part")).withColumn("field", F.col("value"))
    brands = table(spark, sf_dir, "part").where("p_size = 1 and p_brand = 'Brand#1'").select(F.col("p_type").alias("value"))
    return findings.unknown_values(kinds, brands, ["value"], "unmapped_category").select("field", "rule")


def q22_stable_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("group_id"))
    splits = split.assign_splits(names.select("group_id"), names.select("group_id", F.col("segment").alias("class_id")), "customers", 7, 0.7)
    return splits


def q23_unapproved(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = items(spark, sf_dir).join(states, F.col("item_id") == F.col("doc_id"), "left")
    status = F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected").otherwise("candidate")
    stated = rows.withColumn("status", status)
    # a manifest with these annotations: the check of annotations names those that are not approved
    annotations = stated.select(F.col("item_id").cast("string").alias("document"), F.struct(F.col("item_id").cast("string").alias("id"), "status").alias("doc"))
    found = validation.unapproved(annotations)
    return found.join(stated.withColumn("document", F.col("item_id").cast("string")), "document").select("item_id", "status")


def q24_greedy_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_objects(spark, sf_dir)
    return nms.greedy_matches(rows.where("pos % 2 = 0"), rows.where("pos % 2 = 1"), "image_id", accept=0.2).select("image_id", "ref_pos", "pos", F.round("iou", 9).alias("iou"))


def q25_digest_mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).select("item_id", strings.sha256_mod(F.col("image_sha256"), 9).alias("palette"))


def q26_first_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, dropped = dedup.first_of_each(items(spark, sf_dir), "image_sha256", ["item_id"])
    return kept.select("item_id", F.lit("kept").alias("outcome")).unionByName(dropped.select("item_id", F.lit("duplicate_image").alias("outcome")))


def q27_downscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, w, h = geometry.downscaled(F.col("p_size") * 37 + 1, F.col("p_partkey") % 1500 + 1, 640)
    return table(spark, sf_dir, "part").select("p_partkey", w.alias("width"), h.alias("height"))


def q28_inverse_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = geometry.inverse_stretch(Box.named(), F.lit(64), F.lit(64), F.lit(100), F.lit(80))
    rows = objects(spark, sf_dir).where("x1 <= x2 and y1 <= y2").withColumn("box", back)
    return rows.select("image_id", "pos", F.col("box").isNotNull().alias("kept"), *(F.round(F.get("box", F.lit(k)), 6).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))


def q29_export_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of each split in the manifest against those an export holds (one with lines)."""
    items_ = order_items(spark, sf_dir)
    exported = items_.join(objects(spark, sf_dir).select("image_id").distinct(), "image_id", "left_semi")
    return preflight.reconcile(items_, exported).select("split", "declared", "exported")


QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith("q") and name[1].isdigit()}
