"""Detector outputs: decoding of raw rows, validation of detections, inference in Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.geometry import Box, is_finite
from .findings import finding
from .quantiles import medians


def decode_rows(outputs: DataFrame, labels: DataFrame, in_width: int, in_height: int) -> DataFrame:
    """(frame, pos, class_id, confidence, x1..y2) from (frame, width, height, rows array<array<double>>).

    A row is x1, y1, x2, y2, score, class index in the model's input. The index must be whole and among
    ``labels`` (output_index, class_id), the score from 0 to 1, the box not inverted; else it raises. Rows
    without area in the image are left out; pos numbers the others as they come. ``labels`` is broadcast: a model
    has few, and a shuffle by class index would leave all rows to as many tasks.
    """
    raw = outputs.select("frame", "width", "height", F.posexplode("rows").alias("pos", "r"))
    v = [F.get("r", F.lit(k)).cast("double") for k in range(6)]
    joined = raw.withColumn("index", v[5]).join(F.broadcast(labels.select(F.col("output_index").cast("double").alias("index"), "class_id")), "index", "left")
    good = F.col("class_id").isNotNull() & is_finite(v[4]) & (v[4] >= 0) & (v[4] <= 1)
    box = geometry.unstretched(Box(*v[:4]), F.lit(float(in_width)), F.lit(float(in_height)), F.col("width"), F.col("height"))
    checked = F.when(good, box).otherwise(F.raise_error(F.lit("unknown class index or score out of range")).cast("array<double>"))
    # exploded, so that the filter takes the box as it is: pushed below, it would compute it again, and Java leaves so long a
    # method uncompiled
    boxes = joined.select("frame", "pos", "class_id", v[4].alias("confidence"), F.explode(F.array(checked)).alias("box"))
    cut = Box.of(F.col("box"))
    return boxes.where((cut.width > 0) & (cut.height > 0)).select("frame", "pos", "class_id", "confidence", *(F.get("box", F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))


def detection_findings(detections: DataFrame, labels: DataFrame) -> DataFrame:
    """From (document, field, class_id, confidence, width, height, x1..y2): what a detector must not return."""
    known = detections.join(labels.select("class_id").distinct().withColumn("known", F.lit(True)), "class_id", "left")
    rules = F.array_union(
        geometry.box_rules(Box.named(), F.col("width"), F.col("height")),
        F.array_compact(F.array(F.when(F.col("known").isNull(), "unknown_class"), F.when(~(is_finite(F.col("confidence")) & F.col("confidence").between(0, 1)), "confidence_range"))),
    )
    return finding(known.withColumn("rule", F.explode(rules)), F.col("rule"), "detection is not valid")


def infer(tensors: DataFrame, open_session: Callable[[], Callable[[np.ndarray], np.ndarray]], shape: tuple[int, ...], id_col: str = "frame") -> DataFrame:
    """(frame, rows array<array<float>>): a model over (frame, tensor). ``open_session`` runs once a task and
    returns a function from an input of ``shape`` to rows of six numbers."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = open_session()
        for part in parts:
            rows = [np.asarray(model(np.asarray(t, np.float32).reshape(shape))).reshape(-1, 6) for t in part.tensor]
            yield pd.DataFrame({id_col: part[id_col], "rows": [[r.tolist() for r in x] for x in rows]})

    kind = tensors.schema[id_col].dataType.simpleString()
    return tensors.select(id_col, "tensor").mapInPandas(run, f"{id_col} {kind}, rows array<array<float>>")


def onnx_session(model: bytes, input_name: str, shape: tuple[int, ...]) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """An ``open_session`` for a model file with one input of this name and shape and one output; else it raises."""

    def start() -> Callable[[np.ndarray], np.ndarray]:
        import onnxruntime

        session = onnxruntime.InferenceSession(model, providers=["CPUExecutionProvider"])
        inputs, outputs = session.get_inputs(), session.get_outputs()
        if len(inputs) != 1 or len(outputs) != 1 or inputs[0].name != input_name or tuple(inputs[0].shape) != shape or inputs[0].type != "tensor(float)":
            raise ValueError("model does not have the expected input and output")
        return lambda x: session.run(None, {input_name: x})[0]

    return start


def compare_runs(references: DataFrame, decoded: DataFrame, matches: DataFrame, nearest: DataFrame) -> DataFrame:
    """One row: rows of both runs, matched ones, overlaps and side differences, ranges of the scores."""
    a = references.agg(F.count("*").alias("n_references"), F.min("confidence").alias("least_reference_score"), F.max("confidence").alias("greatest_reference_score"))
    b = decoded.agg(F.count("*").alias("n_decoded"), F.min("confidence").alias("least_score"), F.max("confidence").alias("greatest_score"))
    c = matches.agg(F.count("*").alias("n_matched"), F.min("iou").alias("least_iou"))
    d = nearest.agg(F.max("least_delta").alias("greatest_delta"))
    one = [t.withColumn("one", F.lit(1)) for t in (a, b, c, d)]
    middles = [medians(rows.withColumn("one", F.lit(1)), ["one"], [value]).select("one", F.col(value).alias(name)) for rows, value, name in ((matches, "iou", "median_iou"), (nearest, "least_delta", "median_delta"))]
    out = one[0].join(one[1], "one").join(one[2], "one").join(one[3], "one")
    return out.join(middles[0], "one", "left").join(middles[1], "one", "left").drop("one")
