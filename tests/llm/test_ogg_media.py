import hashlib
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curatrix.llm import ogg_media as ogg

from .conftest import EDGE_TEXTS


def crc_by_bits(data):
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300))
def test_checksum(data):
    assert ogg.checksum(data) == crc_by_bits(data)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 500), st.integers(0, 255))
def test_round_trip(units, seed):
    payload = bytes((k * seed + k // 7) % 256 for k in range(units * ogg.UNIT))
    media = ogg.encode(payload)
    back, pages, refused, ms = ogg.decode(media)
    assert back == payload and refused == 0 and pages >= 2 and ms == len(payload) * 1000 // ogg.RATE


def test_pages_are_well_formed():
    payload = b"x" * 100_000 + b" " * 32
    media, at, seen = ogg.encode(payload), 0, {}
    while at < len(media):
        head = struct.unpack_from("<4sBBqIIIB", media, at)
        lacing = media[at + 27 : at + 27 + head[7]]
        stop = at + 27 + head[7] + sum(lacing)
        page = bytearray(media[at:stop])
        page[22:26] = bytes(4)
        assert head[0] == b"OggS" and head[6] == crc_by_bits(bytes(page))
        pages = seen.setdefault(head[4], [])
        assert head[5] == len(pages) and bool(head[2] & 2) == (not pages)
        assert bool(head[2] & 1) == bool(pages and pages[-1][1])
        pages.append((head[2], lacing[-1] == 255, head[3]))
        at = stop
    for pages in seen.values():
        assert pages[-1][0] & 4 and any(p[0] & 1 for p in pages)
    assert sum(p[-1][2] for p in seen.values()) == len(payload)


@pytest.mark.parametrize("where", [5, 30, 700, 3000])
def test_damage_is_noticed(where):
    media = bytearray(ogg.encode(b"ab" * 9600))
    media[where] ^= 1
    payload, _, refused, _ = ogg.decode(bytes(media))
    assert payload is None and refused >= 1
    assert ogg.decode(bytes(media[:-10]))[0] is None and ogg.decode(b"")[0] is None


def test_documents(make_docs):
    media = ogg.encode_texts_as_media(make_docs(EDGE_TEXTS))
    rows = {r.doc_id: r for r in ogg.read_media(media).collect()}
    stored = {r.doc_id: r.media for r in media.collect()}
    for k, text in enumerate(EDGE_TEXTS):
        raw = (text or "").encode()
        payload = raw + b" " * (192 if not raw else -len(raw) % 192)
        r = rows[k + 1]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
        assert r.media_bytes == len(stored[k + 1]) and r.media_sha256 == hashlib.sha256(stored[k + 1]).hexdigest()
    assert rows[5].media_sha256 == rows[6].media_sha256 and rows[5].feature == rows[6].feature
    packets = ogg.media_packets(media).where("doc_id = 8").collect()
    assert sum(len(p.data) for p in packets) == rows[8].payload_bytes and {p.serial for p in packets} == {1, 2}


def test_null_media_and_empty_table(spark, make_docs):
    df = spark.createDataFrame([(1, 5, None)], "doc_id long, n_bytes long, media binary")
    assert ogg.read_media(df).first().payload_sha256 is None
    assert ogg.read_media(df.limit(0)).count() == 0
