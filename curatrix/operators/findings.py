"""The table that all checks return, and the checks that need no particular document."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, strings
from .windows import chunked

FINDING = "document string, field string, rule string, message string"
COLUMNS = ["document", "field", "rule", "message"]


def no_findings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FINDING)


def all_findings(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables).select(*COLUMNS)


def finding(rows: DataFrame, rule: str | Column, message: str | Column, field: str | Column = "field") -> DataFrame:
    """One finding per row, which has ``document`` and a field (a column of that name or given)."""
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    where = F.col("field") if isinstance(field, str) and field == "field" else as_column(field)
    return rows.select(F.col("document").cast("string").alias("document"), where.alias("field"), as_column(rule).alias("rule"), as_column(message).alias("message"))


def exit_status(check: DataFrame | Callable[[], DataFrame]) -> int:
    """0 without findings, 1 with some, and 2 if the check cannot be made: a function that gives the findings, or the job
    that finds them, raises for what it was given (settings, paths, files)."""
    try:
        found = check if isinstance(check, DataFrame) else check()
        return 0 if found.isEmpty() else 1
    except (ValueError, TypeError, OSError, PySparkException):
        return 2


def ordered(findings: DataFrame) -> DataFrame:
    """Findings by document and pointer, as a report lists them."""
    return findings.orderBy("document", "field", "rule", "message")


def invalid_timestamps(rows: DataFrame) -> DataFrame:
    """From (document, field, stamp)."""
    return finding(rows.where(~strings.is_utc_timestamp(F.col("stamp"))), "utc_timestamp", "expected an RFC 3339 timestamp in UTC with Z")


def unordered_times(rows: DataFrame) -> DataFrame:
    """From (document, field, earlier, later): later before earlier; silent if either is invalid."""
    return finding(rows.where(strings.out_of_order(F.col("earlier"), F.col("later"))), "time_order", "time is before the one it must follow")


def repeats(rows: DataFrame, scope: list[str], value: str, pos: list[str]) -> DataFrame:
    """The second and later rows of each value in its scope, in order of ``pos``, with ``occurrence`` from 2.

    A value may hold any share of the rows: those of a frequent value are ranked chunk by chunk.
    """
    return chunked(rows, [*scope, value], pos, occurrence=True).where("occurrence > 1")


def duplicate_values(rows: DataFrame, what: str) -> DataFrame:
    """From (document, field, value, pos): each repeat of a value in its document, at its own pointer.

    A repeat is what stands after the value's first place, so a minimum tells it and no value is ranked.
    """
    firsts = rows.groupBy("document", "value").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return finding(rows.join(firsts, ["document", "value"]).where("pos > first"), "duplicate_id", f"a second {what} of this value")


def broken_boxes(rows: DataFrame) -> DataFrame:
    """From (document, field, bbox array, width, height): the rules each box breaks."""
    hits = rows.withColumn("rule", F.explode(geometry.box_rules(geometry.Box.of(F.col("bbox")), F.col("width"), F.col("height"))))
    return finding(hits, F.col("rule"), "box is not valid in its image")


def previous_of(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """``rows`` with ``previous``, the value of the row before in its group; a group may hold any share of the rows."""
    return chunked(rows, group, order, previous=value)


def split_leaks(items: DataFrame) -> DataFrame:
    """From (document, field, group_id, split, pos): items whose split differs from the item before in the group."""
    rows = previous_of(items, ["document", "group_id"], ["pos"], "split")
    return finding(rows.where(F.col("previous") != F.col("split")), "split_leakage", "group spans several splits")


def frame_order_breaks(frames: DataFrame, session: list[str], order: list[str], index: str = "frame_index") -> DataFrame:
    """Frames whose index is not greater than the one before in their session."""
    return previous_of(frames, session, order, index).where(F.col(index) <= F.col("previous"))


def unknown_values(rows: DataFrame, known: DataFrame, on: list[str], rule: str = "unknown_class", message: str = "value is not declared") -> DataFrame:
    """From (document, field, ...): rows without a partner in ``known``."""
    return finding(rows.join(known.select(*on).distinct(), on, "left_anti"), rule, message)


def differing_fields(rows: DataFrame, pairs: dict[str, tuple[str, str]], rule: str, message: str | Column) -> DataFrame:
    """A finding for each (field: (column, expected column)) whose values differ; null counts as a value."""
    cases = [F.when(~F.col(a).eqNullSafe(F.col(b)), F.lit(field)) for field, (a, b) in pairs.items()]
    hits = rows.withColumn("field", F.explode(F.array_compact(F.array(*cases))))
    return finding(hits, rule, message)
