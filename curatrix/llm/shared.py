"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import checkpointed, compact, counted, fitted, shared_path, shared_root, stored

__all__ = ["checkpointed", "compact", "counted", "fitted", "fresh", "shared_path", "shared_root", "slices", "stored"]

#: A Python worker handles at most about this many bytes of text at once.
SLICE_BYTES = 4 << 20


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column of ``df`` clashes with it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about SLICE_BYTES at most, a longer row alone."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
