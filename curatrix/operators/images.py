"""Canonical images: files decoded, turned, laid on white, shrunk and written again, each in its own task's slice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixels, png
from ..functions.hashes import average_hash

#: Bytes of canonical images that a task gives on at once, a larger one alone.
BATCH_BYTES = 16 << 20
CANONICAL = pa.schema([
    ("ok", pa.bool_()), ("problem", pa.string()), ("oriented", pa.bool_()), ("source_sha256", pa.string()), ("source_width", pa.int32()), ("source_height", pa.int32()),
    ("sha256", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("scale", pa.float64()), ("alpha_policy", pa.string()), ("resample", pa.string()), ("grey", pa.list_(pa.float64())), ("canonical", pa.binary()),
])
KINDS = "ok boolean, problem string, oriented boolean, source_sha256 string, source_width int, source_height int, sha256 string, width int, height int, scale double, alpha_policy string, resample string, grey array<double>, canonical binary"


def canonical(content: bytes, longest_side: int) -> dict:
    """One row of ``canonical_images`` without its name."""
    row: dict = {"ok": False, "source_sha256": hashlib.sha256(content).hexdigest()}
    try:
        image, orientation, clear = png.decode(content)
    except ValueError as e:
        return row | {"problem": str(e)}
    image = pixels.flatten_alpha(png.turned(image, orientation))
    height, width = image.shape[:2]
    scale = min(1.0, longest_side / max(width, height))
    if scale < 1:
        image = pixels.lanczos(image, max(1, round(width * scale)), max(1, round(height * scale)))
    made = png.encode(image)
    return row | {
        "ok": True, "oriented": orientation != 1, "source_width": width, "source_height": height, "sha256": hashlib.sha256(made).hexdigest(), "width": image.shape[1], "height": image.shape[0],
        "scale": scale, "alpha_policy": "composite_white" if clear else "none", "resample": "lanczos" if scale < 1 else "none", "grey": pixels.grey_thumbnail(image).ravel().tolist(), "canonical": made,
    }


def canonical_images(files: DataFrame, longest_side: int = 1280, name: str = "file_name") -> DataFrame:
    """(name, KINDS, h) of PNG files (name, content): the image upright, on white where it is transparent, no longer than
    ``longest_side``, as a PNG with its hash and average hash. ``oriented`` says that the file asked to be turned.

    Files that are no whole PNG, null content and other formats are not ok, with their ``problem``, and have nulls
    elsewhere. Sizes are those of the upright image before and after. An image must fit into a task.
    """
    if longest_side < 1:
        raise ValueError("longest_side must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = pa.schema([batch.schema.field(name), *CANONICAL])
            held: list[dict] = []
            size = 0
            for key, content in zip(batch.column(name).to_pylist(), batch.column("content"), strict=True):
                row = canonical(content.as_py() or b"", longest_side)
                held.append({name: key} | row)
                size += len(row.get("canonical") or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, kinds)
                    held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, kinds)

    made = files.select(name, F.col("content").cast("binary").alias("content")).mapInArrow(run, f"{name} {files.schema[name].dataType.simpleString()}, {KINDS}")
    return made.withColumn("h", F.when(F.col("ok"), average_hash(F.col("grey"))))
