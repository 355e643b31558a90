"""The checks of contract documents, and what needs documents, applied to documents made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, strings
from ..functions.geometry import Box
from ..operators import decode, images, lineage
from ..session import settled, shared_path, shuffled
from ..sources import documents, file_sink, sinks
from . import contracts, ingest, preflight, publishing, records, run_records, validation
from . import made_documents as made
from . import packages as p
from .catalogue import HEIGHT, WIDTH, objects, order_items, table

FIELDS = ("document", "field", "rule")


def q30_strict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no strict reader accepts."""
    nodes = documents.parse_nodes(made.strict_files(table(spark, sf_dir, "part")), invalid_only=True)
    return documents.unreadable(nodes).select(*FIELDS)


def q31_document_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of each document by its first known key; null for none."""
    return documents.kinds(documents.parse_nodes(made.kind_files(table(spark, sf_dir, "part")))).select("document", "contract")


def q32_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where annotations break their schema."""
    nodes = shuffled(settled(documents.parse_nodes(made.schema_files(table(spark, sf_dir, "part")))))
    known = documents.kinds(nodes).where("contract is not null")
    return contracts.schema_findings(nodes, known, contracts.rule_table(spark)).select(*FIELDS)


def q33_dataset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of the data sets, their images, annotations and histories."""
    files, listing = map(settled, made.part_files(table(spark, sf_dir, "part")))
    return validation.audit_datasets(validation.parse(files, listing)).select(*FIELDS)


def q34_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every broken step in the history of each conversation's last revision."""
    turns = table(spark, sf_dir, "conversations")
    typed = validation.parse(made.revision_files(turns)).typed("annotation")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("turn")).select(made.text("c", F.col("conv_id"), "-", F.col("turn")).alias("document"))
    return validation.history_findings(typed.join(last, "document"), typed).select(*FIELDS)


def q35_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of events against the package that they are meant for."""
    parsed = validation.parse(made.event_files(table(spark, sf_dir, "events")))
    loaded = spark.createDataFrame([("pkg", "a" * 64, [("c1", "one")])], "package_id string, manifest_sha256 string, classes array<struct<id:string,label:string>>")
    return validation.event_findings(parsed.typed("event"), F.broadcast(loaded)).unionByName(parsed.schema).select(*FIELDS)


def _packages(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    files, expected = map(settled, made.packages(table(spark, sf_dir, "supplier")))
    adapters = spark.createDataFrame([("ad", "1", ["onnx"])], "id string, version string, formats array<string>")
    rules = {"ad 1": contracts.Rule("object", {"max_det": contracts.integer(1)}, closed=True)}
    return p.check_packages(files, adapters, mode, expected=expected, adapter_rules=rules).select(*FIELDS)


def q36_package_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of the packages' own files."""
    return _packages(spark, sf_dir, "preflight")


def q37_package_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of the packages, the content of their data sets, runs and lineage."""
    return _packages(spark, sf_dir, "audit")


def q38_decoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of a model with an input of 64 x 64, a frame per order: boxes in the image, classes by index."""
    rows = objects(spark, sf_dir).where("x1 <= x2 and y1 <= y2")
    raw = F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")), F.col("confidence") / 10, (F.col("pos") % 3).cast("double"))
    packed = rows.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("pos", raw.alias("r")))).alias("rows"))
    outputs = packed.select(F.col("image_id").alias("frame"), F.lit(100.0).alias("width"), F.lit(80.0).alias("height"), F.col("rows.r").alias("rows"))
    labels = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "output_index int, class_id string")
    found = decode.decode_rows(outputs, labels, 64, 64)
    return found.select("frame", F.col("pos").cast("int").alias("pos"), "class_id", F.round("confidence", 9).alias("confidence"), *(F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")))


def q39_inverse_letterbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a padded input, 8 left, 4 above and at 0.8 of the size, back in the image; null without area."""
    rows = objects(spark, sf_dir)
    box = geometry.inverse_letterbox(Box.named(), F.lit(8.0), F.lit(4.0), F.lit(0.8), F.lit(WIDTH), F.lit(HEIGHT))
    return rows.withColumn("box", box).select("image_id", "pos", F.col("box").isNotNull().alias("kept"), *(F.round(F.get("box", F.lit(k)), 6).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))


def q40_detection_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a detector must not return: boxes out of the image, confidences over 1, undeclared classes."""
    rows = objects(spark, sf_dir).withColumn("confidence", F.col("confidence") * 1.5)
    named = rows.select(F.col("image_id").cast("string").alias("document"), F.concat(F.lit("/"), F.col("pos").cast("string")).alias("field"), "class_id", "confidence", F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), "x1", "y1", "x2", "y2")
    labels = spark.createDataFrame([("A",), ("N",)], "class_id string")
    return decode.detection_findings(named, labels).select(*FIELDS)


def q41_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the responses of a labeler, one per order, that have no finding."""
    rows = objects(spark, sf_dir)
    one = F.struct(F.col("class_id").alias("label"), F.array("x1", "y1", "x2", "y2").alias("box"))
    packed = rows.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("pos", one.alias("d")))).alias("d"))
    responses = packed.select(F.col("image_id").cast("string").alias("document"), F.lit(100).alias("width"), F.lit(80).alias("height"), F.when(F.col("image_id") % 9 == 0, "human").otherwise("locate_anything").alias("source_kind"), F.transform("d", lambda x: x["d"]).alias("detections"))
    ontology = spark.createDataFrame([("a", "A"), ("n", "N")], "id string, label string")
    found, _ = validation.candidates(responses, ontology)
    return found.select("document", F.col("id").alias("object_id"), "class_id")


def _source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(images, decoded) of a source: an image per order; some files lack, do not decode, are turned or are copies."""
    orders = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    images = orders.select(F.col("o_orderkey").alias("id"), name.alias("file_name"))
    fault = F.col("o_orderkey") % 50
    decoded = orders.where(fault != 0).select(name.alias("file_name"), (fault != 1).alias("ok"), (fault == 2).alias("oriented"), F.sha2(F.concat_ws(" ", "o_custkey", F.round("o_totalprice", -5).cast("long")), 256).alias("sha256"), F.lit(100).alias("width"), F.lit(80).alias("height"))
    return images, decoded


def q42_ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every image of a source; images of one customer at a like price are equal."""
    return ingest.outcomes(*_source(spark, sf_dir)).select("id", "reason")


def q43_skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many images of the source were left out, by reason."""
    return preflight.skip_counts(ingest.outcomes(*_source(spark, sf_dir)))


def q44_converted_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the kept images: mapped classes, boxes scaled into 80 x 64, numbered without those left out."""
    kept = ingest.outcomes(*_source(spark, sf_dir)).where("reason is null").select("id", F.lit(0.8).alias("scale"), F.lit(80.0).alias("width"), F.lit(64.0).alias("height"))
    rows = objects(spark, sf_dir)
    category = F.when(F.col("class_id") == "A", 1).when(F.col("class_id") == "N", 2).otherwise(3)
    annotations = rows.select((F.col("image_id") * 100 + F.col("pos")).alias("id"), "image_id", category.cast("long").alias("category_id"), F.array(F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"))
    categories = spark.createDataFrame([(1, "first"), (2, "second"), (3, "third")], "id long, name string")
    mapping, ignored = ingest.mapping_tables(spark, {"first": "a", "second": "b"}, ["third"], ["a", "b"])
    found = ingest.converted_objects(annotations, kept, categories, mapping, ignored)
    return found.select("image_id", "annotation_id", F.col("id").alias("object_id"), "class_id", "dropped")


def q45_dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images, those without objects, objects, small ones and groups of the data set."""
    return preflight.totals(order_items(spark, sf_dir), objects(spark, sf_dir))


def q46_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one strict line of JSON."""
    rows = table(spark, sf_dir, "events")
    # labels that look like numbers which JSON lacks are texts like others
    label = F.element_at(F.array(*map(F.lit, ("NaN", "a,NaN,b", "x:Infinity]", '"-Infinity"', "plain"))), (F.col("event_id") % 5 + 1).cast("int"))
    doc = F.struct("event_id", "user_id", "event_type", label.alias("label"), F.struct(F.col("props").alias("raw"), F.array(F.col("user_id") / 4).alias("score")).alias("source"))
    return sinks.json_lines(rows.select("event_id", doc.alias("doc"))).select("event_id", "line")


def q47_label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label file of each order's image: class index and shares of the image with 17 digits, a line per object."""
    items = order_items(spark, sf_dir).select(F.col("image_id").alias("item_id"), "split", F.lit(100.0).alias("width"), F.lit(80.0).alias("height"))
    rows = objects(spark, sf_dir).select(F.col("image_id").alias("item_id"), "pos", "class_id", F.array("x1", "y1", "x2", "y2").alias("bbox"))
    classes = spark.createDataFrame([("R", 0), ("A", 1), ("N", 2)], "class_id string, index int")
    return sinks.label_lines(rows, items, classes)


def q48_multi_image_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of items, and those of more than one."""
    return ingest.group_sizes(order_items(spark, sf_dir))


def q49_metric_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, whether the priorities of its orders and those of its open orders are the same keys."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("all"), F.collect_set(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))).alias("open"))
    as_map = lambda c: F.map_from_arrays(c, F.transform(c, lambda _: F.lit(1.0)))
    return rows.select("o_custkey", lineage.same_keys(as_map(F.col("all")), as_map(F.col("open"))).alias("same"))


def q50_training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per brand, an epoch per part: the metrics of the best epoch and the number of epochs."""
    epoch = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    share = F.floor(F.col("p_retailprice") / 100).cast("double")
    values = F.create_map(*(F.lit(x) if isinstance(x, str) else x for pair in (("epoch", epoch.cast("double")), (records.BEST_BY, share), ("metrics/precision(B)", F.col("p_size").cast("double")), ("metrics/recall(B)", F.lit(0.5)), ("metrics/mAP50(B)", share + 1), ("train/loss", F.col("p_size") / 2)) for x in pair))
    results = table(spark, sf_dir, "part").select(F.col("p_brand").alias("run"), epoch.alias("pos"), values.alias("values"))
    found = records.training_metrics(results)
    value = lambda name: F.col("metrics")[name].alias(name)
    return found.select("run", value("P"), value("mAP50"), F.col("metrics")["mAP50-95"].alias("mAP"), value("best_epoch"), value("epochs_recorded"), value("train_loss"))


def q51_machine_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that holds on one machine only, of values that begin like a path for some parts."""
    value = F.concat(F.element_at(F.array(*map(F.lit, ("/", "~", "C:\\", "d:/", "", "x/", "c:"))), (F.col("p_partkey") % 7 + 1).cast("int")), F.col("p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", value.alias("value"))
    return rows.select("p_partkey", strings.is_machine_path(F.col("value")).alias("machine"), strings.pointer_escape(F.col("value")).alias("pointer"), strings.stem_of(F.concat("value", F.lit(".tar.gz"))).alias("stem"))


def q52_preflight_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preflights of the orders' images with three other splits: none trains, none validates and none has objects, and
    a few train on objects that are nearly all small and of one class."""
    items, found = order_items(spark, sf_dir), objects(spark, sf_dir)
    ontology = spark.createDataFrame([("A",), ("N",), ("R",), ("Z",)], "class_id string")
    few = items.withColumn("split", F.when(F.col("image_id") % 400 == 1, "train").otherwise("validation"))
    alike = found.withColumn("class_id", F.when(F.col("image_id") % 400 != 1, F.when(F.col("image_id") % 97 == 0, "N").otherwise("A")).when(F.col("pos") == 1, "R").otherwise("A")).withColumn("x2", F.col("x1") + 5)
    cases = {"untrained": (items.withColumn("split", F.lit("validation")), found), "bare": (items.withColumn("split", F.lit("train")), found.withColumn("image_id", -F.col("image_id") - 1)), "few": (few, alike)}
    out = [preflight.preflight_findings(*tables, ontology).select(F.lit(name).alias("case"), "severity", "rule", F.coalesce("class_id", F.lit("")).alias("class_id")) for name, tables in cases.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def q53_dataset_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data sets built from parts and published as files, a brand each, and read again: an image's hash, an annotation's id
    and status, a manifest's number of items; and why other brands were left out."""
    path = shared_path(spark, "datasets")
    _, found = publishing.publish_datasets(*made.dataset_parts(table(spark, sf_dir, "part")), path)
    files = file_sink.read_files(spark, path).withColumn("text", F.decode("content", "UTF-8"))
    member = lambda name: F.get_json_object("text", f"$.{name}")
    counted = F.size(F.from_json("text", "items array<string>")["items"]).cast("string")
    detail = F.when(F.col("path").endswith(".png"), F.col("sha256")).when(F.col("path").endswith("/dataset.json"), counted).otherwise(F.concat_ws(" ", member("id"), member("status")))
    return files.select("path", detail.alias("detail")).unionByName(found.select(F.concat("document", "field").alias("path"), F.col("rule").alias("detail")))


def q54_training_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training folders of the published data sets, read again: hashes of images, labels, configuration and mapping, the
    data set that a mapping names; and why other data sets were left out."""
    source, path = shared_path(spark, "datasets"), shared_path(spark, "training")
    publishing.publish_datasets(*made.dataset_parts(table(spark, sf_dir, "part")), source)
    # the data sets are this query's own, and a small file takes a whole block: they go before as many files are written again
    _, found = publishing.publish_training_folders(file_sink.read_files(spark, source), path, lambda: file_sink.discard(source))
    files = file_sink.read_files(spark, path)
    named = F.get_json_object(F.decode("content", "UTF-8"), "$.dataset_id")
    detail = F.when(F.col("path").endswith("/mapping.json"), named).otherwise(F.col("sha256"))
    return files.select("path", detail.alias("detail")).unionByName(found.select(F.concat("document", "field").alias("path"), F.col("rule").alias("detail")))


def q55_run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of training runs, one per part: precision of the best epoch, its number and the model's hash; and the rules
    that other runs break."""
    good, found = run_records.training_records(*made.training_runs(table(spark, sf_dir, "part")))
    doc = F.from_json(F.decode("content", "UTF-8"), "metrics map<string,double>, outputs array<struct<role:string,artifact:struct<path:string,sha256:string>>>")
    kept = good.select(F.col("run").cast("string").alias("run"), doc.alias("d")).select("run", F.lit("").alias("field"), F.concat_ws(" ", F.col("d.metrics")["P"].cast("string"), F.col("d.metrics")["best_epoch"].cast("int").cast("string"), F.get("d.outputs", F.lit(0))["artifact"]["sha256"]).alias("detail"))
    return kept.unionByName(found.select(F.col("document").alias("run"), "field", F.col("rule").alias("detail")))


def q56_source_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation documents written from orders, by years and keys, and read again in ranges of 64 KiB: every annotation with its
    image and category."""
    path = shared_path(spark, "sources")
    file_sink.publish_files(made.source_documents(table(spark, sf_dir, "orders"), objects(spark, sf_dir)), path)
    source = ingest.read_source(spark, f"{path}/*.json", range_bytes=1 << 16)
    # images are as many as orders, categories are three
    images_, categories = shuffled(source.images.select(F.col("id").alias("image_id"), "file_name")), F.broadcast(source.categories.distinct().select(F.col("id").alias("category_id"), "name"))
    named = source.annotations.join(images_, "image_id").join(categories, "category_id")
    return named.select("id", "file_name", "name", *(F.get("bbox", F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))


def q57_canonical_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG files made from the vectors, decoded: size and sum of the grey values; those that are damaged are not ok, with zeros."""
    found = images.canonical_images(made.image_files(table(spark, sf_dir, "embeddings")))
    grey = F.aggregate("grey", F.lit(0.0), lambda a, x: a + x)
    return found.select("file_name", "ok", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("width", "height")), F.coalesce(F.round(grey).cast("long"), F.lit(0)).alias("grey"))


QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith("q") and name[1].isdigit()}
