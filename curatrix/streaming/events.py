"""Detection events as streams: assembly, order and uniqueness kept in state, and a sink of JSON lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import findings as f
from ..plans.validation import TYPES, event_findings
from ..sources.sinks import write_json_lines

def assemble(frames: DataFrame, detections: DataFrame, labels: DataFrame, package_id: str, manifest_sha256: str, event_id: Column, emitted_at: Column) -> DataFrame:
    """(frame, doc): one event per frame. ``frames`` has frame, source (struct), captured_at, width and height;
    ``detections`` frame, rank, class_id, confidence, x1 to y2; ``labels`` class_id and label.

    A frame without detections has an empty list. A frame that failed must not be among ``frames``.
    """
    named = detections.join(labels, "class_id")
    one = F.struct("rank", F.struct(F.array("x1", "y1", "x2", "y2").alias("bbox"), F.col("class_id"), F.col("label"), F.col("confidence")).alias("d"))
    packed = named.groupBy("frame").agg(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["d"]).alias("detections"))
    none = F.array().cast("array<struct<bbox:array<double>,class_id:string,label:string,confidence:double>>")
    rows = frames.join(packed, "frame", "left")
    doc = F.struct(
        F.lit("1.0.0").alias("schema_version"), event_id.alias("event_id"), F.col("captured_at"), emitted_at.alias("emitted_at"), F.col("source"),
        F.struct(F.lit(package_id).alias("package_id"), F.lit(manifest_sha256).alias("manifest_sha256")).alias("model"),
        F.struct(F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height")).alias("image"),
        F.coalesce("detections", none).alias("detections"),
    )
    return rows.select("frame", doc.alias("doc"))


def read_events(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """(document, doc) of a folder of JSON lines, new files as they come."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.format("text").load(path)
    return lines.select(F.sha2("value", 256).alias("document"), F.from_json("value", TYPES["event"]).alias("doc"))


ORDERED = "source_id string, session_id string, event_id string, frame_index long, problem string"


def check_order(events: DataFrame) -> DataFrame:
    """Frames whose index does not rise within their (source, session): source_id, session_id, event_id,
    frame_index and problem, null for a frame in order. Works on streams and keeps the last index of a
    session as state, for as long as the query runs. Frames of one micro-batch count in order of event id's
    arrival as given by ``arrival``, which rises.

    ``events`` has source_id, session_id, event_id, frame_index, arrival.
    """

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(parts)).sort_values("arrival", kind="stable")
        problems = []
        for index in rows.frame_index:
            bad = last is not None and index <= last
            problems.append("frame_order" if bad else None)
            last = index if last is None or not bad else last
        state.update((int(last),))
        yield pd.DataFrame({"source_id": key[0], "session_id": key[1], "event_id": rows.event_id, "frame_index": rows.frame_index, "problem": problems})

    return events.groupBy("source_id", "session_id").applyInPandasWithState(judge, ORDERED, "last long", "append", GroupStateTimeout.NoTimeout)


def check_unique(events: DataFrame, id_col: str = "event_id") -> DataFrame:
    """(event_id, copies, problem): events seen before, in this batch or an earlier one. State: a flag for each
    id, as long as the query runs; a bound on time would let a late copy pass."""

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = sum(len(p) for p in parts)
        seen = state.get[0] if state.exists else 0
        state.update((seen + n,))
        yield pd.DataFrame({"event_id": [key[0]], "copies": [seen + n], "problem": ["duplicate_id" if seen + n > 1 else None]})

    return events.groupBy(id_col).applyInPandasWithState(judge, "event_id string, copies long, problem string", "seen long", "append", GroupStateTimeout.NoTimeout)


def without_retries(events: DataFrame, id_col: str = "event_id", time_col: str = "captured", delay: str = "1 hour") -> DataFrame:
    """Each event once, for sinks that retries reach; copies must come within ``delay``."""
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def start_checked_sink(events: DataFrame, out: str, findings_out: str, checkpoint: str, packages: DataFrame | None = None, once: bool = True):  # noqa: ANN201
    """Writes sound events as JSON lines and the findings of the others as a table, batch by batch.

    ``events`` is a stream (document, doc). A batch is written under its number, so a repeated batch replaces
    itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        found = event_findings(batch, packages).persist()
        sound = batch.join(found.select("document").distinct(), "document", "left_anti")
        write_json_lines(sound, f"{out}/batch={number}", mode="overwrite")
        found.write.mode("overwrite").parquet(f"{findings_out}/batch={number}")
        found.unpersist()
        batch.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def failed_frames(frames: DataFrame, reason: str) -> DataFrame:
    """Findings of frames that gave no event; failures never count as empty events."""
    return f.finding(frames.select(F.col("frame").cast("string").alias("document")), reason, "frame gave no event", field=F.lit(""))
