"""Media columns in Ogg: bytes stored as 8-bit samples in packets, pages and logical streams.

Writing: the payload is cut into packets, dealt in turn to two logical streams. A packet's length is laced
into segments of 255 bytes; pages take a fixed number of segments, so packets run on over pages. Each
page has a checksum and the granule position, the samples of its stream up to the last packet that
ends on it. Pages of the two streams are multiplexed.

Reading: pages are found and their checksums verified, streams demultiplexed by serial number, packets put
together from the lacing values, timestamps derived from granule positions, and the packets of
both streams merged by time into the payload.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

#: Fixed values of the container: the capture pattern, header layout and flags of a page.
CAPTURE, HEADER = b"OggS", struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
#: The payload's unit, padded with spaces.
UNIT, PADDING = 192, b" "
#: Samples of a packet, segments of a page, samples a second, number of streams.
PACKET, PAGE_SEGMENTS, RATE, STREAMS = 6 * UNIT, 64, 8000, 2
#: The first packet of a stream: name, version, rate, samples of a packet, streams, this stream, payload bytes.
STREAM_HEADER = struct.Struct("<4sBIHBBQ")
STREAM_NAME = b"PCM8"
REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """The container's CRC-32: polynomial 04c11db7, not reflected, from 0. It is zlib's on reversed bits."""
    value = zlib.crc32(page.translate(REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(value.to_bytes(4, "little").translate(REVERSED), "big")


def payload_of(text: str) -> tuple[int, bytes]:
    """(bytes of the text, the payload: padded with spaces up to a positive multiple of the unit)."""
    raw = text.encode()
    return len(raw), raw + PADDING * (UNIT - len(raw) if not raw else -len(raw) % UNIT)


def _pages(packets: list[bytes], serial: int, samples: list[int]) -> list[bytes]:
    """The pages of a logical stream; ``samples`` counts the samples of the stream up to each packet's end."""
    lacing, data, ends = bytearray(), [], {}
    for packet, count in zip(packets, samples, strict=True):
        full, rest = divmod(len(packet), 255)
        lacing += b"\xff" * full + bytes([rest])
        data.append(packet)
        ends[len(lacing)] = count
    body, out, at, byte = b"".join(data), [], 0, 0
    # the header packet has a page of its own
    cut = len(packets[0]) // 255 + 1
    number = 0
    while at < len(lacing):
        stop = min(len(lacing), at + (cut if not at else PAGE_SEGMENTS))
        laced = bytes(lacing[at:stop])
        size = sum(laced)
        done = [k for k in range(stop, at, -1) if k in ends][:1]
        flags = CONTINUED * (at > 0 and lacing[at - 1] == 255) | FIRST * (at == 0) | LAST * (stop == len(lacing))
        head = [CAPTURE, 0, flags, ends[done[0]] if done else -1, serial, number, 0, len(laced)]
        page = laced + body[byte : byte + size]
        head[6] = checksum(HEADER.pack(*head) + page)
        out.append(HEADER.pack(*head) + page)
        at, byte, number = stop, byte + size, number + 1
    return out


def encode(payload: bytes) -> bytes:
    """The payload as a physical bitstream."""
    packets = [payload[k : k + PACKET] for k in range(0, len(payload), PACKET)]
    streams = []
    for s in range(STREAMS):
        own = packets[s::STREAMS]
        header = STREAM_HEADER.pack(STREAM_NAME, 1, RATE, PACKET, STREAMS, s, len(payload))
        streams.append(_pages([header, *own], s + 1, [0, *np.cumsum([len(p) for p in own], dtype=np.int64).tolist()]))
    turns = range(max(map(len, streams)))
    return b"".join(pages[k] for k in turns for pages in streams if k < len(pages))


class Stream:
    """A logical stream as it is read: ``packets`` holds (packet, granule position of its page, or -1)."""

    def __init__(self) -> None:
        self.packets: list[tuple[bytes, int]] = []
        self.open: list[bytes] | None = None
        self.next = 0
        self.ended = False

    def page(self, flags: int, granule: int, number: int, lacing: bytes, body: bytes) -> None:
        if number != self.next or (self.open is not None) != bool(flags & CONTINUED):
            # a page is missing: what it began or ended is lost
            self.open = None
        skip = bool(flags & CONTINUED) and self.open is None
        self.next = number + 1
        self.ended |= bool(flags & LAST)
        at = start = 0
        for size in lacing:
            at += size
            if size < 255:
                if not skip:
                    self.packets.append((b"".join([*(self.open or ()), body[start:at]]), granule))
                self.open, skip, start = None, False, at
        if lacing and lacing[-1] == 255 and not skip:
            self.open = [*(self.open or ()), body[start:at]]


def read_streams(media: bytes) -> tuple[dict[int, Stream], int, int]:
    """(streams by serial number, pages read, pages refused: wrong checksum, cut off or not a page)."""
    streams: dict[int, Stream] = {}
    at, pages, refused = 0, 0, 0
    while (at := media.find(CAPTURE, at)) >= 0:
        if at + HEADER.size > len(media):
            return streams, pages, refused + 1
        _, _, flags, granule, serial, number, crc, segments = HEADER.unpack_from(media, at)
        lacing = media[at + HEADER.size : at + HEADER.size + segments]
        stop = at + HEADER.size + segments + sum(lacing)
        page = media[at:stop]
        if len(lacing) < segments or stop > len(media) or checksum(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            refused += 1
            at += len(CAPTURE)
            continue
        streams.setdefault(serial, Stream()).page(flags, granule, number, lacing, page[HEADER.size + segments :])
        pages += 1
        at = stop
    return streams, pages, refused


def timed_packets(stream: Stream) -> list[tuple[bytes, int]]:
    """(packet, samples of the stream up to its end): a page's granule belongs to its last packet, those
    before it end as many samples earlier as follow."""
    out: list[tuple[bytes, int]] = []
    group: list[bytes] = []
    packets = stream.packets[1:]
    for k, (packet, granule) in enumerate(packets):
        group.append(packet)
        if k + 1 == len(packets) or packets[k + 1][1] != granule:
            end = granule
            ends = []
            for p in reversed(group):
                ends.append(end)
                end -= len(p)
            out += zip(group, reversed(ends), strict=True)
            group = []
    return out


def decode(media: bytes) -> tuple[bytes | None, int, int, int]:
    """(payload, pages, refused pages, duration in ms); the payload is null unless all of it was read."""
    streams, pages, refused = read_streams(media)
    merged: list[tuple[int, int, bytes]] = []
    total = 0
    for serial, stream in streams.items():
        head = stream.packets[0][0] if stream.packets else b""
        if len(head) != STREAM_HEADER.size or not head.startswith(STREAM_NAME):
            continue
        _, _, rate, size, count, own, total = STREAM_HEADER.unpack(head)
        # a packet's start on the common time line: the streams take turns
        merged += [((end - len(p)) * count + own * size, serial, p) for p, end in timed_packets(stream)]
    merged.sort(key=lambda x: x[:2])
    payload = b"".join(p for _, _, p in merged)
    whole = len(payload) == total and streams and all(s.ended for s in streams.values())
    return payload if whole else None, pages, refused, total * 1000 // RATE


def features(payload: bytes) -> str:
    """Of the samples: mean, energy about 128 and crossings of the mean, as integers."""
    samples = np.frombuffer(payload, np.uint8).astype(np.int64)
    mean = int(samples.sum()) // len(samples)
    above = samples > mean
    return f"mean={mean};energy={int(((samples - 128) ** 2).sum())};crossings={int((above[1:] != above[:-1]).sum())}"


def encode_texts_as_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_bytes of the unpadded text, media (binary).

    Whole texts; a null text counts as empty and gives one unit of spaces. Equal texts give equal bytes.
    Repeated rows are kept; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = [(n, encode(payload)) for n, payload in map(payload_of, (t or "" for t in batch.column("text").to_pylist()))]
            yield pa.record_batch([batch.column("id"), pa.array([n for n, _ in made], pa.int64()), pa.array([m for _, m in made], pa.binary())], ["id", "n_bytes", "media"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, n_bytes long, media binary").withColumnRenamed("id", id_col)


READ = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pages int, refused_pages int, duration_ms long"


def read_media(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From (id_col, n_bytes, media): both and what the stored bytes say once read back.

    A null or damaged media, whose payload is not whole, has null payload columns and feature; pages with
    a wrong checksum are counted in refused_pages and give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            rows = []
            for stored_bytes in batch.column("media").to_pylist():
                if stored_bytes is None:
                    rows.append((None,) * 9)
                    continue
                payload, pages, refused, ms = decode(stored_bytes)
                read = (None, None, None) if payload is None else (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
                rows.append((*read, len(stored_bytes), hashlib.sha256(stored_bytes).hexdigest(), None if payload is None else features(payload) + f";ms={ms}", pages, refused, ms))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch([batch.column("id"), batch.column("n_bytes"), *columns], ["id", "n_bytes", *(x.split()[0] for x in READ.split(", "))])

    source = media.select(F.col(id_col).alias("id"), "n_bytes", "media")
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, n_bytes long, {READ}").withColumnRenamed("id", id_col)


def media_packets(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per packet of each media value: id_col, serial, packet (number), end_ms, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            for doc, value in zip(batch.column("id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                for serial, stream in sorted(read_streams(value or b"")[0].items()):
                    timed = timed_packets(stream)
                    if timed:
                        n = len(timed)
                        yield pa.record_batch([pa.array([doc] * n, batch.column("id").type), pa.array([serial] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([end * STREAMS * 1000 // RATE for _, end in timed], pa.int64()), pa.array([p for p, _ in timed], pa.binary())], ["id", "serial", "packet", "end_ms", "data"])

    source = media.select(F.col(id_col).alias("id"), "media")
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, serial long, packet int, end_ms long, data binary").withColumnRenamed("id", id_col)
