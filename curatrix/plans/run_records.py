"""Records of training, evaluation and export runs, made from the files that the runs left.

Runs come as a row each, their files as (run, path, content). A run whose files lack, differ from what they must be or
cannot be read gives findings and no record. Hashes are those of the bytes at hand. Records are judged by their
contract, and their config for values that mean something on one machine only, before they are given out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import SHA256
from ..operators import findings as f
from ..session import settled, shuffled
from . import packages, records
from . import validation as v

#: Where the files of a run lie.
DATASET, BEST, LAST, RESULTS, ARGS = "config/dataset.json", "weights/best.pt", "weights/last.pt", "results.csv", "args.yaml"
METRICS, MODEL, PROBE = "evaluation/metrics.json", "model.onnx", "export/probe.json"


def _hashed(files: DataFrame, paths: list[str]) -> DataFrame:
    """(run, hashes): the hash of each of a run's files by path; of a path given twice none is known."""
    own = shuffled(files).where(F.col("path").isin(*paths)).groupBy("run", "path").agg(F.count("*").alias("n"), F.first(F.sha2("content", 256)).alias("sha256")).where("n = 1")
    return own.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("path", "sha256"))).alias("hashes"))


def _gated(runs: DataFrame, files: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(runs with their hashes, findings of files that lack)."""
    rows = settled(runs.join(_hashed(files, paths), "run", "left").withColumn("document", F.col("run").cast("string")))
    lacking = rows.select("document", F.explode(F.filter(F.array(*map(F.lit, paths)), lambda p: F.coalesce(~F.map_contains_key("hashes", p), F.lit(True)))).alias("path"))
    return rows, f.finding(lacking, "artifact_missing", "the run did not leave this file, or more than one", field=F.concat(F.lit("/"), "path"))


def _artifact(role: str, path: str) -> tuple[str, str, Column]:
    return role, path, F.col("hashes")[path]


def _implementation(name: str) -> Column:
    return F.struct(F.lit(name).alias("name"), F.col("implementation_version").alias("version"), F.lit("pinned").alias("code_revision"))


def _config(own: Column, more: Column | None = None) -> Column:
    """A config as JSON text: the struct's members, then those of ``more``, an object as JSON text, if it holds any."""
    text = F.to_json(own)
    if more is None:
        return text
    rest = F.regexp_extract(more, r"(?s)^\s*\{(.*)\}\s*$", 1)
    return F.when(more.isNull() | (F.btrim(rest) == ""), text).otherwise(F.concat(F.regexp_replace(text, r"\}$", ","), rest, F.lit("}")))


def _judged(rows: DataFrame, found: DataFrame, stage: str, name: str, config: Column, inputs: Column, outputs: Column, metrics: Column) -> tuple[DataFrame, DataFrame]:
    """(records (run, content), all findings): the records of the runs without a finding that keep their contract."""
    rows = rows.withColumn("_config", config)
    unread = f.finding(rows.where(F.try_parse_json("_config").isNull()), "strict_json", "the config is no object, or has a member twice", field=F.lit("/config"))
    found = settled(f.all_findings(found, unread))
    good = rows.join(found.select("document").distinct(), "document", "left_anti")
    doc = records.record(F.lit(stage), F.col("record_id"), F.col("created_at"), _implementation(name), F.col("_config"), inputs, outputs, metrics)
    # a run without metrics has no such member, and null members are left out of JSON
    written = settled(good.select("run", "document", F.concat(F.to_json(doc), F.lit("\n")).cast("binary").alias("content")))
    parsed = v.parse(written.select("document", "content", F.sha2("content", 256).alias("sha256")))
    broken = settled(f.all_findings(parsed.schema, packages.open_config_findings(parsed.nodes, "/config")))
    kept = written.join(broken.select("document").distinct(), "document", "left_anti").select("run", "content")
    return kept, f.all_findings(found, broken)


def training_records(runs: DataFrame, files: DataFrame, implementation: str = "ultralytics") -> tuple[DataFrame, DataFrame]:
    """(records, findings) of training runs: run, record_id, created_at, implementation_version, profile, config_file,
    pretrained_ref, pretrained_sha256, dataset_yolo, dataset_sha256 (of the manifest that was trained on) and the arguments
    epochs, imgsz, batch and val.

    A run must have left its arguments, results, both checkpoints and a copy of the manifest, byte for byte. Its metrics
    are those of the best epoch; results without epochs, with values that are not finite or without the detection
    metrics bar it.
    """
    rows, lacking = _gated(runs, files, [ARGS, RESULTS, BEST, LAST, DATASET])
    texts = files.where(F.col("path") == RESULTS).join(rows.select("run"), "run", "left_semi").select("run", F.decode("content", "UTF-8").alias("value"))
    epochs = settled(records.results_rows(texts))
    wrong = epochs.where("problem is not null").select(F.col("run").cast("string").alias("document"), "problem").distinct()
    short = epochs.where((F.col("pos") == 0) & (F.size(F.array_except(F.array(*map(F.lit, records.METRICS)), F.map_keys("values"))) > 0))
    found = f.all_findings(
        lacking,
        f.finding(rows.where(F.col("hashes")[DATASET] != F.col("dataset_sha256")), "hash_mismatch", "the copy of the manifest has other bytes", field=F.lit(f"/{DATASET}")),
        f.finding(rows.where(~F.coalesce(F.rlike("pretrained_sha256", F.lit(SHA256)), F.lit(False))), "artifact_missing", "the pretrained weights have no hash", field=F.lit("/config/pretrained_weights")),
        f.finding(wrong, "results_invalid", F.col("problem"), field=F.lit(f"/{RESULTS}")),
        f.finding(short.select(F.col("run").cast("string").alias("document")), "results_invalid", "results lack detection metrics", field=F.lit(f"/{RESULTS}")),
    )
    barred = settled(f.all_findings(found))
    usable = epochs.join(barred.select(F.col("document").alias("of")).distinct(), F.col("run").cast("string") == F.col("of"), "left_anti")
    measured = rows.join(records.training_metrics(usable.select("run", "pos", "values")), "run", "left")
    config = _config(F.struct(
        "profile", "config_file", F.struct(F.col("pretrained_ref").alias("path"), F.col("pretrained_sha256").alias("sha256")).alias("pretrained_weights"), "dataset_yolo",
        *(F.col(c).cast("double").alias(c) for c in ("epochs", "imgsz", "batch")), "val", F.col("metrics")["best_epoch"].alias("best_epoch"),
    ))
    outputs = records.artifacts(_artifact("model", BEST), _artifact("checkpoint", LAST), _artifact("results", RESULTS))
    return _judged(measured, barred, "training", implementation, config, records.artifacts(_artifact("dataset", DATASET)), outputs, F.col("metrics"))


def evaluation_records(runs: DataFrame, files: DataFrame, implementation: str = "ultralytics") -> tuple[DataFrame, DataFrame]:
    """(records, findings) of evaluations: run, record_id, created_at, implementation_version, split, sample_count,
    metric_definitions, metrics and thresholds (maps), and config, more members as JSON text or null. The manifest, the checkpoint and the metrics' file must be there."""
    rows, lacking = _gated(runs, files, [DATASET, BEST, METRICS])
    own = F.struct("split", "metric_definitions", F.transform_values("thresholds", lambda _, x: x.cast("double")).alias("thresholds"), F.col("sample_count").cast("long").alias("sample_count"))
    config = _config(own, F.col("config"))
    inputs = records.artifacts(_artifact("dataset", DATASET), _artifact("model", BEST))
    return _judged(rows, f.all_findings(lacking, records.evaluation_input_findings(rows)), "evaluation", implementation, config, inputs, records.artifacts(_artifact("metrics", METRICS)), F.col("metrics"))


def export_records(runs: DataFrame, files: DataFrame, implementation: str = "ultralytics") -> tuple[DataFrame, DataFrame]:
    """(records, findings) of exports: run, record_id, created_at, implementation_version and config, more members as JSON text or null. The
    checkpoint, the model and the probe must be there; the record names the model's hash twice, as output and in its config."""
    rows, lacking = _gated(runs, files, [BEST, MODEL, PROBE])
    config = _config(F.struct(F.struct(F.lit(MODEL).alias("path"), F.col("hashes")[MODEL].alias("sha256")).alias("model_output")), F.col("config"))
    outputs = records.artifacts(_artifact("model", MODEL), _artifact("probe", PROBE))
    return _judged(rows, lacking, "export", implementation, config, records.artifacts(_artifact("model", BEST)), outputs, F.lit(None).cast("map<string,double>"))
