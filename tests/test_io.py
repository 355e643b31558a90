import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from curatrix.plans import records, validation
from curatrix.sources import documents, sinks
from curatrix.streaming import events

from .builders import event
from .test_validation import frame, put


def test_files_are_read_with_paths_and_hashes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_bytes(b"{}")
    (tmp_path / "y.txt").write_bytes(b"y")
    rows = {r.path: r.sha256 for r in documents.read_files(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a/x.json", "y.txt"} and all(len(h) == 64 for h in rows.values())


REF = "document string, field string, path string, sha256 string"


def test_first_root_wins_and_bad_files_are_not_passed_over(spark):
    refs = spark.createDataFrame([("d", "/1", "a", "h1"), ("d", "/2", "b", "h2"), ("d", "/3", "c", "h3"), ("d", "/4", "../e", "h"), ("d", "/5", "x", "h5"), ("d", "/6", "y", "h6")], REF)
    kind = "document string, root_rank int, path string, sha256 string, problem string"
    files = spark.createDataFrame([("d", 0, "a", "h1", None), ("d", 1, "a", "other", None), ("d", 0, "b", "other", None), ("d", 1, "b", "h2", None), ("d", 0, "x", None, "path_escape"), ("d", 1, "x", "h5", None), ("d", 0, "y", None, None)], kind)
    good, found = validation.resolve_each(refs, files)
    assert [r.field for r in good.collect()] == ["/1"]
    assert {(r.field, r.rule) for r in found.collect()} == {("/2/sha256", "hash_mismatch"), ("/3/path", "artifact_missing"), ("/4/path", "invalid_path"), ("/5/path", "path_escape"), ("/6/sha256", "artifact_io")}


def test_links_are_followed_inside_their_root_only(spark, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir()
    second.mkdir()
    (tmp_path / "outside.txt").write_bytes(b"o")
    (second / "here.txt").write_bytes(b"h")
    (second / "good.txt").symlink_to(second / "here.txt")
    (first / "out.txt").symlink_to(tmp_path / "outside.txt")
    (second / "out.txt").write_bytes(b"never reached")
    (first / "ring").symlink_to(first / "ring")
    names = ["here.txt", "good.txt", "out.txt", "ring", "none.txt", "../outside.txt"]
    refs = spark.createDataFrame([("d", f"/{n}", n, hashlib.sha256(b"h").hexdigest()) for n in names], REF)
    listing = documents.posix_listing(refs, [str(first), str(second)]).withColumn("document", F.lit("d"))
    good, found = validation.resolve_each(refs, listing, "artifact_unresolved")
    assert {r.path for r in good.collect()} == {"here.txt", "good.txt"}
    assert {(r.field, r.rule) for r in found.collect()} == {("/out.txt/path", "path_escape"), ("/ring/path", "artifact_io"), ("/none.txt/path", "artifact_unresolved"), ("/../outside.txt/path", "invalid_path")}


def test_image_listing(spark, tmp_path):
    for name in ("a.PNG", "b.jpeg", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    rows = documents.image_files(spark, str(tmp_path)).collect()
    assert len(rows) == 2 and all(r.captured_at.endswith("Z") for r in rows)


def test_json_lines_are_strict(spark, tmp_path):
    doc = F.struct(F.lit("é\n").alias("a"), F.col("x"))
    rows = spark.createDataFrame([(1.5,)], "x double").select(doc.alias("doc"))
    sinks.write_json_lines(rows, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    assert json.loads(text) == {"a": "é\n", "x": 1.5} and text.count("\n") == 1
    with pytest.raises(Exception, match="non-finite"):
        sinks.write_json_lines(spark.createDataFrame([(float("nan"),)], "x double").select(doc.alias("doc")), str(tmp_path / "bad"))


def test_publishing_is_all_or_nothing(spark, tmp_path):
    out = str(tmp_path / "released")
    table = spark.range(3)
    with pytest.raises(ValueError, match="not published"):
        sinks.publish(spark, {"t": table}, out, check=lambda t: t["t"].where("id = 2"))
    assert not (tmp_path / "released").exists()
    sinks.publish(spark, {"t": table}, out, check=lambda t: t["t"].where("id = 5"))
    assert spark.read.parquet(out + "/t").count() == 3
    with pytest.raises(FileExistsError):
        sinks.publish(spark, {"t": table}, out)


def test_label_export(spark):
    items = spark.createDataFrame([("i0", 0, "train", 100, 80, "x/a.PNG"), ("i1", 1, "validation", 10, 10, "b.jpg")], "item_id string, pos int, split string, width int, height int, path string")
    objects = spark.createDataFrame([("i0", 1, "c2", [0.0, 0.0, 10.0, 8.0]), ("i0", 0, "c1", [10.0, 20.0, 30.0, 60.0])], "item_id string, pos int, class_id string, bbox array<double>")
    classes = spark.createDataFrame([("c1", 0), ("c2", 1)], "class_id string, index int")
    tables = sinks.export_labels(objects, items, classes)
    files = {r.stem: (r.folder, r.text) for r in tables["files"].collect()}
    assert files["image-000001"] == ("val", "")
    lines = files["image-000000"][1].splitlines()
    assert lines[0] == "0 " + " ".join(format(v, ".17g") for v in (40 / 200, 80 / 160, 0.2, 0.5)) and lines[1].startswith("1 ")
    assert {r.image for r in tables["mapping"].collect()} == {"images/train/image-000000.png", "images/val/image-000001.jpg"}
    with pytest.raises(ValueError):
        sinks.export_labels(objects, items.where("split = 'train'"), classes)


def test_positions_are_gapless(spark):
    rows = sinks.with_positions(spark.range(0, 500).select((F.col("id") * 7 % 500).alias("v")), ["v"]).collect()
    assert all(r.v == r.pos for r in rows) and len(rows) == 500


def test_results_tables(spark, tmp_path):
    head = "epoch, time,train/box,metrics/precision(B),metrics/recall(B),metrics/mAP50(B),metrics/mAP50-95(B),val/box"
    (tmp_path / "r.csv").write_text(head + "\n1,x,0.5,0.1,0.2,0.3,0.4,1\n2,x,0.4,0.2,0.3,0.4,0.6,2\n3,x,0.3,0.3,0.4,0.5,0.6,3\n")
    results = records.read_results(spark, str(tmp_path / "r.csv"))
    assert "time" not in results.first()["values"]
    got = records.training_metrics(results).first().metrics
    assert got == {"P": 0.2, "R": 0.3, "mAP50": 0.4, "mAP50-95": 0.6, "best_epoch": 2.0, "epochs_recorded": 3.0, "train_box": 0.4, "val_box": 2.0}
    (tmp_path / "bad.csv").write_text("epoch,a\n1,NaN\n")
    with pytest.raises(Exception, match="non-finite"):
        records.read_results(spark, str(tmp_path / "bad.csv")).collect()


def test_results_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("epoch,metrics/precision(B),metrics/recall(B),metrics/mAP50(B),metrics/mAP50-95(B)\n1,0.1,0.2,0.3,0.4\n")
    (tmp_path / "b.csv").write_text('metrics/mAP50-95(B), metrics/mAP50(B) ,metrics/recall(B),metrics/precision(B),epoch,"a ""q"", b"\r\n0.4,0.3,0.2,0.1,1,"7",extra\r\n\r\n0.3,,0.2\r\n')
    rows = {(r.run.rsplit("/", 1)[1], r.pos): r["values"] for r in records.read_results(spark, str(tmp_path)).collect()}
    one = {"epoch": 1.0, "metrics/precision(B)": 0.1, "metrics/recall(B)": 0.2, "metrics/mAP50(B)": 0.3, "metrics/mAP50-95(B)": 0.4}
    assert rows == {("a.csv", 0): one, ("b.csv", 0): one | {'a "q", b': 7.0}, ("b.csv", 1): {"metrics/mAP50-95(B)": 0.3, "metrics/recall(B)": 0.2}}
    got = {r.run.rsplit("/", 1)[1]: r.metrics["P"] for r in records.training_metrics(records.read_results(spark, str(tmp_path))).collect()}
    assert got == {"a.csv": 0.1, "b.csv": 0.1}


@pytest.mark.parametrize("content", ["epoch,metrics/recall(B)\n", "\n\n"])
def test_results_without_epochs_are_refused(spark, tmp_path, content):
    (tmp_path / "r.csv").write_text(content)
    with pytest.raises(Exception, match="no epochs"):
        records.read_results(spark, str(tmp_path / "r.csv")).collect()


def test_json_lines_judge_numbers_and_not_texts(spark):
    texts = ["NaN", "a,NaN,b", "x:Infinity]", '"-Infinity"', "]NaN}"]
    rows = spark.createDataFrame([(k, (t, 1.5, [2.0], {t: 0.5})) for k, t in enumerate(texts)], "k int, doc struct<label:string,score:double,more:array<double>,by:map<string,float>>")
    lines = [json.loads(r.line) for r in sinks.json_lines(rows).orderBy("k").collect()]
    assert lines == [{"label": t, "score": 1.5, "more": [2.0], "by": {t: 0.5}} for t in texts]
    for score, more, by in ((float("nan"), [], {}), (1.0, [float("inf")], {}), (1.0, [], {"a": float("-inf")})):
        bad = spark.createDataFrame([(("x", score, more, by),)], rows.select("doc").schema)
        with pytest.raises(Exception, match="non-finite"):
            sinks.json_lines(bad).collect()


def test_evaluation_inputs(spark):
    kind = "document string, split string, sample_count long, metric_definitions map<string,string>, metrics map<string,double>, thresholds map<string,double>"
    rows = [("ok", "test", 5, {"a": "x"}, {"a": 1.0}, {"t": 0.5}), ("bad", "train", 0, {"a": "x"}, {"b": 1.0}, {})]
    found = records.evaluation_input_findings(spark.createDataFrame(rows, kind))
    assert sorted((r.document, r.field) for r in found.collect()) == [("bad", "/config/sample_count"), ("bad", "/config/split"), ("bad", "/config/thresholds"), ("bad", "/metrics")]


def test_labeling_records(spark):
    doc = {k: '"x"' for k in records.LABELING_FIELDS} | {"kind": '"labeling_run"', "command": '["run", "in.png"]', "checkpoint": json.dumps({"sha256": "a" * 64})}
    rows = [("ok", doc), ("bad", {k: v for k, v in doc.items() if k != "tool"} | {"kind": '"other"', "command": '["C:\\\\x"]', "checkpoint": json.dumps({"sha256": "zz"})})]
    found = records.labeling_findings(spark.createDataFrame(rows, "document string, doc map<string,string>"))
    assert sorted((r.document, r.field) for r in found.collect()) == [("bad", "/command/0"), ("bad", "/kind"), ("bad", "/sha256"), ("bad", "/tool")]


def run_to_memory(df, name, tmp_path):
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return query


FRAMES = "source_id string, session_id string, event_id string, frame_index long, arrival long"


def test_frame_order_over_micro_batches(spark, tmp_path):
    folder = tmp_path / "in"
    batches = [[("cam", "s", "e1", 1, 1), ("cam", "s", "e2", 3, 2), ("cam", "t", "e3", 1, 3)], [("cam", "s", "e4", 3, 4), ("cam", "s", "e5", 4, 5)]]
    for rows in batches:
        spark.createDataFrame(rows, FRAMES).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1)
    stream = spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(str(folder))
    run_to_memory(events.check_order(stream), "ordered", tmp_path)
    assert {r.event_id: r.problem for r in spark.table("ordered").collect()} == {"e1": None, "e2": None, "e3": None, "e4": "frame_order", "e5": None}
    run_to_memory(events.check_unique(stream.withColumn("event_id", F.col("session_id"))), "unique", tmp_path)
    assert {(r.event_id, r.problem) for r in spark.table("unique").collect()} == {("s", "duplicate_id"), ("t", None)}


def test_checked_sink_matches_the_batch_checks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good, bad = event("good"), event("bad", put(["emitted_at"], "2024-05-01T09:00:00Z"))
    (tmp_path / "in" / "e.jsonl").write_bytes(good[1] + b"\n" + bad[1] + b"\n")
    stream = events.read_events(spark, str(tmp_path / "in"))
    events.start_checked_sink(stream, str(tmp_path / "out"), str(tmp_path / "found"), str(tmp_path / "cp")).awaitTermination(120)
    lines = [json.loads(x) for x in "".join(p.read_text() for p in (tmp_path / "out").rglob("part*")).splitlines()]
    assert [x["event_id"] for x in lines] == ["good"]
    found = spark.read.parquet(str(tmp_path / "found"))
    batch = validation.event_findings(events.read_events(spark, str(tmp_path / "in"), streaming=False))
    assert [r.rule for r in found.collect()] == [r.rule for r in batch.collect()] == ["time_order"]


def test_assembled_events_keep_their_contract(spark):
    frames = spark.createDataFrame([("f0", ("cam", "image", "s", 0), "2024-05-01T10:00:00Z", 64, 48), ("f1", ("cam", "image", "s", 1), "2024-05-01T10:00:01Z", 64, 48)], "frame string, source struct<id:string,kind:string,session_id:string,frame_index:long>, captured_at string, width int, height int")
    detections = spark.createDataFrame([("f0", 1, "c1", 0.5, 0.0, 0.0, 5.0, 5.0), ("f0", 0, "c1", 0.9, 1.0, 1.0, 5.0, 5.0)], "frame string, rank int, class_id string, confidence double, x1 double, y1 double, x2 double, y2 double")
    labels = spark.createDataFrame([("c1", "one")], "class_id string, label string")
    made = events.assemble(frames, detections, labels, "pkg", "a" * 64, F.concat(F.lit("ev-"), F.col("frame")), F.lit("2024-05-01T10:00:02Z"))
    lines = {r.frame: r.line for r in sinks.json_lines(made).select("frame", "line").collect()}
    assert [d["confidence"] for d in json.loads(lines["f0"])["detections"]] == [0.9, 0.5] and json.loads(lines["f1"])["detections"] == []
    parsed = validation.parse(frame(spark, [(k, v.encode()) for k, v in lines.items()]))
    assert parsed.schema.isEmpty() and validation.event_findings(parsed.typed("event")).isEmpty()
    assert [r.rule for r in events.failed_frames(frames.limit(1), "decode_failed").collect()] == ["decode_failed"]


def test_retries_are_dropped_within_the_watermark(spark):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:01"), ("b", "2024-01-01 00:00:00")], "event_id string, t string").withColumn("captured", F.to_timestamp("t"))
    assert rows.dropDuplicates(["event_id"]).count() == 2
