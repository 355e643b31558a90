"""The arrays of one large JSON document, read by many tasks.

A document is cut into byte ranges anywhere, in strings, escapes and characters too. What a range means depends on where
it begins: outside a string, in one, or in one behind a backslash. A first pass computes for each of these three
states what the range does to it: the state at its end, how far brackets outside strings lift or lower the depth,
how low it gets, and the last place at which each depth was left upwards. These summaries compose, so a prefix scan over
blocks of ranges and then over ranges gives every range its true state, depth and the array that it begins in.

The second pass finds the elements of the document's own arrays. An element belongs to the range in which it
begins; its task reads on beyond the range's end until the element is whole. All arrays come out of one pass.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as files_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, spread
from .file_sink import _place

#: Bytes of a range; a task reads as many beyond it at a time.
RANGE_BYTES = 32 << 20
#: Ranges of a block of the scan.
BLOCK_RANGES = 1_024
#: Bytes that are read back at a time for an array's name, and of elements that a task gives on at once.
BACK_BYTES, BATCH_BYTES = 4_096, 8 << 20
#: Outside strings, in one, in one behind a backslash.
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
QUOTE, BACKSLASH = 34, 92
SUMMARY = "path string, k long, start long, size long, summary string"
SPACE = b" \t\r\n"


def _quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """(places of the quotes that no backslash escapes, whether the byte after the data is escaped)."""
    slashes = np.flatnonzero(data == BACKSLASH)
    quotes = np.flatnonzero(data == QUOTE)
    # the length of the run of backslashes that ends at each of them
    breaks = np.flatnonzero(np.diff(slashes) != 1) + 1
    firsts = np.concatenate(([0], breaks)).astype(np.int64) if len(slashes) else slashes
    first_of = np.repeat(slashes[firsts], np.diff(np.append(firsts, len(slashes)))) if len(slashes) else slashes
    lengths = slashes - first_of + 1 + ((first_of == 0) & escaped)

    def run_before(places: np.ndarray) -> np.ndarray:
        at = np.searchsorted(slashes, places) - 1
        touches = (at >= 0) & (slashes[at] == places - 1) if len(slashes) else np.zeros(len(places), bool)
        out = np.where(touches, lengths[at] if len(slashes) else 0, 0)
        return out + ((places == 0) & escaped)

    return quotes[run_before(quotes) % 2 == 0], bool(run_before(np.array([len(data)]))[0] % 2)


def _brackets(data: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places of the brackets outside strings, depth after each of them relative to the start, state at the end)."""
    quotes, escaped = _quotes(data, state == ESCAPED)
    places = np.flatnonzero((data == 123) | (data == 91) | (data == 125) | (data == 93))
    inside = state != OUTSIDE
    places = places[(np.searchsorted(quotes, places) % 2 == 1) == inside]
    lifts = np.where((data[places] == 123) | (data[places] == 91), 1, -1)
    at_end = (len(quotes) % 2 == 1) != inside
    return places, np.cumsum(lifts), (ESCAPED if escaped else INSIDE) if at_end else OUTSIDE


def summarise(data: bytes, start: int) -> list[list]:
    """What a range does from each state: [state at the end, depth gained, lowest depth, {depth left upwards: last place}]."""
    array, out = np.frombuffer(data, np.uint8), []
    for state in (OUTSIDE, INSIDE, ESCAPED):
        places, depths, end = _brackets(array, state)
        before = np.concatenate(([0], depths))[:-1] if len(depths) else depths
        ups = depths > before
        # later places overwrite earlier ones
        opens = dict(zip(before[ups].tolist(), (places[ups] + start).tolist(), strict=True))
        out.append([end, int(depths[-1]) if len(depths) else 0, min(0, int(depths.min(initial=0))), opens])
    return out


def compose(first: list[list], second: list[list]) -> list[list]:
    """The summary of two ranges that follow each other."""
    out = []
    for end, gained, lowest, opens in first:
        end2, gained2, lowest2, opens2 = second[end]
        out.append([end2, gained + gained2, min(lowest, gained + lowest2), opens | {depth + gained: at for depth, at in opens2.items()}])
    return out


NOTHING: list[list] = [[s, 0, 0, {}] for s in (OUTSIDE, INSIDE, ESCAPED)]


def _dump(summary: list[list]) -> str:
    return json.dumps(summary)


def _load(text: str) -> list[list]:
    return [[end, gained, lowest, {int(k): v for k, v in opens.items()}] for end, gained, lowest, opens in json.loads(text)]


def _ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(path, k, start, size) of the ranges of the files at ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / range_bytes)))
    rows = files.select("path", "length", cut.alias("k")).withColumn("start", F.col("k") * range_bytes)
    # a range is a task's unit of work, so ranges are spread before they are read
    return spread(rows.select("path", "k", "start", F.least(F.lit(range_bytes), F.col("length") - F.col("start")).alias("size")), "path", "k")


def _summaries(ranges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, place = _place(row["path"])
                with fs.open_input_file(place) as f:
                    summary = summarise(f.read_at(row["size"], row["start"]), row["start"])
                yield pa.RecordBatch.from_pylist([row | {"summary": _dump(summary)}], pa.schema([("path", pa.string()), ("k", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("summary", pa.string())]))

    return ranges.mapInArrow(run, SUMMARY)


def _scanned(summaries: DataFrame, block_ranges: int) -> DataFrame:
    """(path, start, size, state, depth, opened): how each range begins, and where the container of depth 1 that it begins in
    was opened. A file whose brackets do not close raises."""
    blocked = summaries.withColumn("block", F.floor(F.col("k") / block_ranges))

    def whole(table: pa.Table) -> pa.Table:
        total = NOTHING
        for row in table.sort_by("k").to_pylist():
            total = compose(total, _load(row["summary"]))
        return pa.table({"path": table.column("path").slice(0, 1), "block": table.column("block").slice(0, 1), "summary": pa.array([_dump(total)])})

    def before(table: pa.Table) -> pa.Table:
        rows, total = [], NOTHING
        for row in table.sort_by("block").to_pylist():
            rows.append({"path": row["path"], "block": row["block"], "before": _dump(total)})
            total = compose(total, _load(row["summary"]))
        end, gained, lowest, _ = total[OUTSIDE]
        if end != OUTSIDE or gained or lowest < 0:
            raise ValueError(f"{rows[0]['path']} is no whole JSON document")
        return pa.Table.from_pylist(rows, pa.schema([("path", pa.string()), ("block", pa.int64()), ("before", pa.string())]))

    def placed(table: pa.Table) -> pa.Table:
        rows = []
        ordered = table.sort_by("k").to_pylist()
        total = _load(ordered[0]["before"])
        for row in ordered:
            state, depth, _, opens = total[OUTSIDE]
            rows.append({"path": row["path"], "start": row["start"], "size": row["size"], "state": state, "depth": depth, "opened": opens.get(1) if depth > 1 else None})
            total = compose(total, _load(row["summary"]))
        return pa.Table.from_pylist(rows, pa.schema([("path", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("state", pa.int32()), ("depth", pa.int64()), ("opened", pa.int64())]))

    blocks = blocked.groupBy("path", "block").applyInArrow(whole, "path string, block long, summary string")
    starts = blocks.groupBy("path").applyInArrow(before, "path string, block long, before string")
    return blocked.join(starts, ["path", "block"]).groupBy("path", "block").applyInArrow(placed, "path string, start long, size long, state int, depth long, opened long")


def name_before(f: files_of.FileSystem, at: int) -> str | None:
    """The member name that stands before a place, with its colon; None if what stands there is no name."""
    held = b""
    while True:
        start = max(0, at - len(held) - BACK_BYTES)
        held = f.read_at(at - len(held) - start, start) + held
        text = held.rstrip(SPACE)
        if text.endswith(b":"):
            text = text[:-1].rstrip(SPACE)
            if text.endswith(b'"'):
                # a string begins at a quote that an even number of backslashes precedes
                end = len(text) - 1
                begin = text.rfind(b'"', 0, end)
                while begin > 0 and (begin - len(text[:begin].rstrip(b"\\"))) % 2:
                    begin = text.rfind(b'"', 0, begin)
                if begin > 0:
                    return json.loads(text[begin:].decode())
        elif text and start < at - len(held):
            return None
        if not start:
            return None


def _before(f: files_of.FileSystem, at: int) -> tuple[bytes, int]:
    """(byte, place) of the last one before a place that is no white space; an empty one at the start."""
    while at > 0:
        start = max(0, at - BACK_BYTES)
        text = f.read_at(at - start, start).rstrip(SPACE)
        if text:
            return text[-1:], start + len(text) - 1
        at = start
    return b"", 0


def _elements(ranges: DataFrame, names: list[str], range_bytes: int) -> DataFrame:
    """(path, name, offset, text) of the elements of the documents' own arrays of these names, and a row without a
    text where such an array begins."""
    kinds = pa.schema([("path", pa.string()), ("name", pa.string()), ("offset", pa.int64()), ("text", pa.string())])

    def of_range(row: dict) -> Iterator[tuple[str, int, bytes | None]]:
        fs, place = _place(row["path"])
        with fs.open_input_file(place) as f:
            data, start = f.read_at(row["size"], row["start"]), row["start"]
            places, depths, state = _brackets(np.frombuffer(data, np.uint8), row["state"])
            depths = depths + row["depth"]
            depth = int(depths[-1]) if len(depths) else row["depth"]
            opened = row["opened"]
            name = name_before(f, opened) if opened is not None else None
            in_array = opened is not None and f.read_at(1, opened) == b"["
            begun: int | None = None
            # behind the end of the last element, or of the array's bracket; unknown where the range begins inside
            last: int | None = None

            def between(stop: int, comma: bool) -> None:
                """Raises unless a comma, or nothing, stands between two elements, or the last one and the array's end."""
                if last is not None:
                    good = data[last - start : stop - start].strip(SPACE) == (b"," if comma else b"")
                else:
                    byte, where = _before(f, stop)
                    if comma and byte == b",":
                        byte, where = _before(f, where)
                        good = byte in (b"}", b"]")
                    else:
                        good = where == opened or (not comma and byte in (b"}", b"]"))
                if not good:
                    raise ValueError(f"{row['path']}: what stands before byte {stop} of {name} is no element")

            first = False
            at = 0
            while True:
                # once the range is over only an element that it began is read to its end
                marks = np.flatnonzero(depths[at:] <= 3) + at
                for k in marks.tolist():
                    where, here = int(places[k]), int(depths[k])
                    byte, before = data[where], int(depths[k - 1]) if k else row["depth"]
                    if here == 2 and before == 1:
                        opened = start + where
                        name, in_array, last, first = name_before(f, opened), byte == 91, opened + 1, True
                        if name in names and in_array:
                            yield name, opened, None
                    elif here == 1 and before == 2:
                        if name in names and in_array:
                            between(start + where, comma=False)
                        name, in_array, last = None, False, None
                    elif name in names and in_array and here == 3 and before == 2:
                        between(start + where, comma=not first)
                        if where >= row["size"]:
                            return
                        begun, first = where, False
                    elif begun is not None and here == 2:
                        yield name, start + begun, data[begun : where + 1]
                        begun, last = None, start + where + 1
                        if where >= row["size"]:
                            return
                if begun is None:
                    return
                at = len(depths)
                more = f.read_at(range_bytes, start + len(data))
                if not more:
                    raise ValueError(f"{row['path']} ends inside an element")
                new, lifted, state = _brackets(np.frombuffer(more, np.uint8), state)
                places, depths = np.concatenate((places, new + len(data))), np.concatenate((depths, lifted + depth))
                depth = int(depths[-1]) if len(depths) else depth
                data += more

    def packed(path: str, held: list[tuple[str, int, str | None]]) -> pa.RecordBatch:
        columns = zip(*held, strict=True) if held else ((), (), ())
        return pa.record_batch([pa.array([path] * len(held), pa.string()), *(pa.array(c, k.type) for c, k in zip(columns, list(kinds)[1:], strict=True))], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held: list[tuple[str, int, str | None]] = []
                size = 0
                for name, offset, text in of_range(row):
                    held.append((name, offset, None if text is None else text.decode()))
                    size += len(text or b"")
                    if size >= BATCH_BYTES:
                        yield packed(row["path"], held)
                        held, size = [], 0
                yield packed(row["path"], held)

    return spread(ranges, "path", "start").mapInArrow(run, "path string, name string, offset long, text string")


def array_parts(spark: SparkSession, path: str, names: list[str], range_bytes: int = RANGE_BYTES, block_ranges: int = BLOCK_RANGES) -> DataFrame:
    """``array_elements``, and for each array found a row without a text, so that an empty one is told from none."""
    summaries = checkpointed(_summaries(_ranges(spark, path, range_bytes)))
    return _elements(_scanned(summaries, block_ranges), names, range_bytes)


def array_elements(spark: SparkSession, path: str, names: list[str], range_bytes: int = RANGE_BYTES, block_ranges: int = BLOCK_RANGES) -> DataFrame:
    """(path, name, offset, text) of the elements, objects or arrays, of the arrays ``names`` that the documents at
    ``path`` hold at their top, in one pass over each byte range after the scan; ``offset`` orders them.

    Documents whose brackets or strings do not close raise, and so does anything but white space and single commas
    between the elements. What lies outside these arrays is not judged. Documents without a byte give no rows. An element
    must fit into a task.
    """
    return array_parts(spark, path, names, range_bytes, block_ranges).where("text is not null")
