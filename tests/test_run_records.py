import hashlib
import json

import pytest
from pyspark.sql import functions as F

from curatrix.plans import run_records as r

STAMP = "2024-05-01T10:00:00Z"
HEAD = "epoch,metrics/precision(B),metrics/recall(B),metrics/mAP50(B),metrics/mAP50-95(B),train/box\n"
FILES = {"args.yaml": b"epochs: 2\n", "results.csv": (HEAD + "1,0.1,0.2,0.3,0.4,9\n2,0.5,0.6,0.7,0.8,7\n").encode(), "weights/best.pt": b"best", "weights/last.pt": b"last", "config/dataset.json": b"{}"}
sha = lambda b: hashlib.sha256(b).hexdigest()


def files(spark, runs):
    return spark.createDataFrame([(run, p, bytearray(c)) for run, held in runs.items() for p, c in held.items()], "run string, path string, content binary")


def found(table):
    return {(x.document, x.field, x.rule) for x in table.collect()}


def training(spark, cases, **change):
    kind = "run string, record_id string, created_at string, implementation_version string, profile string, config_file string, pretrained_ref string, pretrained_sha256 string, dataset_yolo string, dataset_sha256 string, epochs int, imgsz int, batch int, val boolean"
    row = {"record_id": "rec", "created_at": STAMP, "implementation_version": "8", "profile": "small", "config_file": "c.yaml", "pretrained_ref": "p.pt", "pretrained_sha256": "a" * 64, "dataset_yolo": "yolo", "dataset_sha256": sha(b"{}"), "epochs": 2, "imgsz": 640, "batch": 4, "val": True} | change
    runs = spark.createDataFrame([(run, *row.values()) for run in cases], kind)
    good, bad = r.training_records(runs, files(spark, cases))
    return {x.run: json.loads(bytes(x.content)) for x in good.collect()}, found(bad)


def test_a_training_record_of_whole_files(spark):
    records, bad = training(spark, {"a": FILES})
    assert not bad
    doc = records["a"]
    assert doc["stage"] == "training" and doc["implementation"] == {"name": "ultralytics", "version": "8", "code_revision": "pinned"}
    assert doc["metrics"] == {"P": 0.5, "R": 0.6, "mAP50": 0.7, "mAP50-95": 0.8, "best_epoch": 2.0, "epochs_recorded": 2.0, "train_box": 7.0}
    assert doc["config"]["best_epoch"] == 2.0 and doc["config"]["val"] is True and doc["config"]["epochs"] == 2.0
    assert doc["inputs"] == [{"role": "dataset", "artifact": {"path": "config/dataset.json", "sha256": sha(b"{}")}}]
    assert [(o["role"], o["artifact"]["sha256"]) for o in doc["outputs"]] == [("model", sha(b"best")), ("checkpoint", sha(b"last")), ("results", sha(FILES["results.csv"]))]


def test_gates_of_training(spark):
    less = lambda *names: {k: v for k, v in FILES.items() if k not in names}
    results = lambda text: FILES | {"results.csv": text.encode()}
    cases = {
        "good": FILES, "none": {}, "last": less("weights/last.pt"), "copy": FILES | {"config/dataset.json": b"{ }"}, "head": results(HEAD), "empty": results(""),
        "inf": results(HEAD + "1,0.1,0.2,0.3,inf,9\n"), "lack": results("epoch,metrics/recall(B)\n1,0.5\n"),
    }
    records, bad = training(spark, cases)
    assert set(records) == {"good"}
    assert bad == {("none", f"/{p}", "artifact_missing") for p in FILES} | {
        ("last", "/weights/last.pt", "artifact_missing"), ("copy", "/config/dataset.json", "hash_mismatch"), ("lack", "/results.csv", "results_invalid"),
        ("head", "/results.csv", "results_invalid"), ("empty", "/results.csv", "results_invalid"), ("inf", "/results.csv", "results_invalid"),
    }


@pytest.mark.parametrize(("change", "field", "rule"), [
    ({"config_file": "/home/me/c.yaml"}, "/config/config_file", "non_portable_config"),
    ({"record_id": ""}, "/id", "schema"),
    ({"pretrained_sha256": None}, "/config/pretrained_weights", "artifact_missing"),
])
def test_records_that_break_their_contract_are_kept_back(spark, change, field, rule):
    records, bad = training(spark, {"a": FILES}, **change)
    assert not records and ("a", field, rule) in bad


def test_evaluations_and_exports(spark):
    held = {"config/dataset.json": b"{}", "weights/best.pt": b"best", "evaluation/metrics.json": b"m", "model.onnx": b"onnx", "export/probe.json": b"p"}
    kind = "run string, record_id string, created_at string, implementation_version string, split string, sample_count int, metric_definitions map<string,string>, metrics map<string,double>, thresholds map<string,double>, config string"
    rows = [("a", "e", STAMP, "8", "test", 3, {"m": "d"}, {"m": 0.5}, {"iou": 0.5}, '{"more": [1, 2]}'), ("b", "e", STAMP, "8", "train", 0, {"m": "d"}, {"k": 0.5}, {}, None), ("c", "e", STAMP, "8", "test", 3, {"m": "d"}, {"m": 0.5}, {"iou": 0.5}, '{"split": "test"}')]
    good, bad = r.evaluation_records(spark.createDataFrame(rows, kind), files(spark, {"a": held, "b": held, "c": held}))
    docs = {x.run: json.loads(bytes(x.content)) for x in good.collect()}
    assert set(docs) == {"a"} and docs["a"]["config"] == {"split": "test", "metric_definitions": {"m": "d"}, "thresholds": {"iou": 0.5}, "sample_count": 3, "more": [1, 2]}
    assert found(bad) == {("b", f"/config/{k}", "evaluation_config") for k in ("split", "sample_count", "thresholds")} | {("b", "/metrics", "evaluation_config"), ("c", "/config", "strict_json")}
    runs = spark.createDataFrame([("a", "x", STAMP, "8", '{"opset": 17}'), ("b", "x", STAMP, "8", None)], "run string, record_id string, created_at string, implementation_version string, config string")
    good, bad = r.export_records(runs, files(spark, {"a": held, "b": {k: v for k, v in held.items() if k != "model.onnx"}}))
    doc = json.loads(bytes(good.first().content))
    assert doc["config"] == {"model_output": {"path": "model.onnx", "sha256": sha(b"onnx")}, "opset": 17} and "metrics" not in doc
    assert found(bad) == {("b", "/model.onnx", "artifact_missing")}
    assert good.where(F.col("run") == "b").isEmpty()
