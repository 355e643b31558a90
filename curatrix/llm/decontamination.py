"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are what is left of a text, A-Z lower-cased, when it is cut at all ASCII characters but letters and digits.
An item gives its windows of WINDOW consecutive words; an item of fewer words is one window. A window is a pattern,
and the search's symbols are words, its blocks two of them:

* the shift table says for each block how far from the end of any pattern it stands; a block in no pattern lets the
  search skip all positions that would need it, nine words at a time for windows of ten;
* where the shift is zero, the end of some pattern may stand here. The bucket of that last block, split by the first
  block of its patterns, gives the few that can;
* direct comparison of their words confirms the occurrences.

Short items would shorten every shift, so patterns of one length have tables of their own. Patterns are not copied: a
pattern is a place in the list of its item's words.

The tables of at most MAX_WINDOWS windows go to the tasks at once. A larger benchmark is cut into pieces that overlap by
a window less one word and dealt into groups of bounded size; each group is a pass over the documents, and the words
that are hit are joined by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices
from .simhash import numbered

#: Words of a window, and of a block of the tables.
WINDOW, BLOCK = 10, 2
#: Windows whose tables are broadcast at once, about 400 bytes each; a group of pieces holds half of it on average.
MAX_WINDOWS = 200_000
#: Words of a piece of an item.
PIECE_WORDS = 2_000
#: Bytes of words to themselves, A-Z to a-z, others to a space. Bytes from 0x80 belong to words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Patterns:
    """Shift table and buckets of the patterns of one length, which are places in ``flat``."""

    def __init__(self, length: int, flat: list[bytes], places: Iterable[int]) -> None:
        self.length, self.flat, self.block = length, flat, min(BLOCK, length)
        #: Without any known block at its end a pattern ends this many words on at least.
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[int]]] = {}
        for at in places:
            for end in range(self.block, length + 1):
                block = tuple(flat[at + end - self.block : at + end])
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            first = tuple(flat[at : at + self.block])
            # after the loop the block is the pattern's last one
            self.buckets.setdefault(block, {}).setdefault(first, []).append(at)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, place of the pattern) of all occurrences, by first word."""
        shift, far, block, length, flat = self.shift, self.far, self.block, self.length, self.flat
        end, n = length, len(words)
        while end <= n:
            step = shift.get(tuple(words[end - block : end]), far)
            if step:
                end += step
                continue
            at = end - length
            places = self.buckets[tuple(words[end - block : end])].get(tuple(words[at : at + block]))
            if places:
                here = words[at:end]
                for place in places:
                    if flat[place : place + length] == here:
                        yield at, place
            end += 1


class Searcher:
    """The patterns of pieces (item, words); ``search`` gives the hit spans of a text and the items that occur."""

    def __init__(self, pieces: Iterable[tuple[str, str]], window: int = WINDOW) -> None:
        self.items: list[str] = []
        flat: list[bytes] = []
        places: dict[int, list[int]] = {}
        known: dict[bytes, bytes] = {}
        for item, text in pieces:
            words = [known.setdefault(w, w) for w in text.encode().split()]
            length = min(window, len(words))
            if length:
                places.setdefault(length, []).extend(range(len(flat), len(flat) + len(words) - length + 1))
                flat += words
                self.items += [item] * len(words)
        self.patterns = [Patterns(length, flat, own) for length, own in sorted(places.items())]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for patterns in self.patterns:
            last = -1
            for at, place in patterns.occurrences(words):
                items.add(self.items[place])
                if at != last:
                    found.append((at, at + patterns.length))
                    last = at
        return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_pieces(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(item, piece, words, windows): each item's words joined by a space, in pieces whose windows are the item's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows: list[tuple[str, int, str, int]] = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                for k in range(-(-max(0, len(words) - window + 1) // piece_words) or bool(words)):
                    own = words[k * piece_words : (k + 1) * piece_words + window - 1]
                    rows.append((item, k, b" ".join(own).decode(), max(1, len(own) - window + 1)))
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int32(), pa.string(), pa.int32()))], ["item", "piece", "words", "windows"])

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item string, piece int, words string, windows int")


def _searched(rows: DataFrame, pieces: list[tuple[str, str]], window: int) -> DataFrame:
    """(row, n_words, spans, items) from (row, text)."""
    sent = rows.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(sent.value, window)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, "text"):
            counts, spans, items = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                hit, held = searcher.search(words)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in hit])
                items.append(sorted(held))
            yield pa.record_batch([batch.column("row"), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))], ["row", "n_words", "spans", "items"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n_words long, spans array<struct<start:long,end:long>>, items array<string>")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``id_col``, n_words, spans (start and end, exclusive, of the runs of hit words, from 0) and items (sorted distinct
    ids, as strings, of the items with a window in the text), a row for each row of ``docs``.

    Null and empty texts have no words. Null item texts and items without words have no windows; a null item id is
    written as an empty string; items of one id are one item. Repeated documents are rows each. Whole texts are
    searched, however long. Other columns are not read; an empty benchmark hits nothing, an empty table gives none.
    """
    spark = docs.sparkSession
    pieces = item_pieces(benchmark, item_col, item_text_col, window)
    total = pieces.agg(F.coalesce(F.sum("windows"), F.lit(0)).alias("n")).first().n
    if total <= max_windows:
        rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).cast("string").alias("text"))
        held = [(r.item, r.words) for r in pieces.select("item", "words").collect()]
        return _searched(rows, held, window).withColumnRenamed("row", id_col)
    # beyond the bound: one pass over the documents for each group of pieces, joined by row
    groups = -(-2 * total // max_windows)
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("item", "piece"), F.lit(groups)))
    rows = numbered(docs.select(id_col, text_col)).select("row", F.col("d0").alias("id"), F.col("d1").cast("string").alias("text"))
    found = None
    for k in range(groups):
        held = [(r.item, r.words) for r in grouped.where(F.col("group") == k).select("item", "words").collect()]
        own = _searched(rows.select("row", "text"), held, window).where(F.size("items") > 0)
        found = own if found is None else found.unionByName(own)
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    last = lambda done: F.element_at(done, -1)
    joined = F.aggregate(
        spans, F.slice(spans, 1, 0),
        lambda done, s: F.when((F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end"))))).otherwise(F.concat(done, F.array(s))),
    )
    hits = found.groupBy("row").agg(joined.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    counts = _searched(rows.select("row", "text"), [], window).select("row", "n_words")
    whole = rows.select("row", F.col("id").alias(id_col)).join(counts, "row").join(hits, "row", "left")
    return whole.select(id_col, "n_words", F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row of ``docs``."""
    found = find_contamination(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
