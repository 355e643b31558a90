import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from curatrix.functions import pixels, png
from curatrix.operators import images
from curatrix.plans import ingest


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def packed(samples, depth):
    """Rows of samples as bytes."""
    rows = samples.reshape(len(samples), -1)
    if depth == 16:
        return np.stack([rows >> 8, rows & 255], axis=2).astype(np.uint8).reshape(len(rows), -1)
    if depth == 8:
        return rows.astype(np.uint8)
    bits = (rows[:, :, None] >> np.arange(depth - 1, -1, -1)) & 1
    return np.packbits(bits.reshape(len(rows), -1).astype(np.uint8), axis=1)


def filtered(rows, step, rng):
    """Each row under a filter of its own."""
    out, above = b"", [0] * rows.shape[1]
    for row in rows.tolist():
        kind = rng.randrange(5)
        line = []
        for i, value in enumerate(row):
            left, up, corner = row[i - step] if i >= step else 0, above[i], above[i - step] if i >= step else 0
            near = min((abs(left + up - corner - x), k, x) for k, x in enumerate((left, up, corner)))[2]
            line.append((value - (0, left, up, (left + up) // 2, near)[kind]) & 255)
        out += bytes([kind, *line])
        above = row
    return out


def written(samples, colour, depth, interlaced=False, more=b"", seed=0):
    rng = random.Random(seed)
    height, width, channels = samples.shape
    step = max(1, depth * channels // 8)
    parts = [samples[y::dy, x::dx] for x, y, dx, dy in png.PASSES] if interlaced else [samples]
    raw = b"".join(filtered(packed(p, depth), step, rng) for p in parts if p.size)
    data = zlib.compress(raw)
    head = struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, int(interlaced))
    return png.SIGNATURE + chunk(b"IHDR", head) + more + chunk(b"IDAT", data[:7]) + chunk(b"IDAT", data[7:]) + chunk(b"tEXt", b"k\0v") + chunk(b"IEND", b"")


def exif(orientation, order=">"):
    return chunk(b"eXIf", (b"MM\0*" if order == ">" else b"II*\0") + struct.pack(f"{order}IHHHIHHI", 8, 1, png.ORIENTATION, 3, 1, orientation, 0, 0))


@pytest.mark.parametrize("interlaced", [False, True])
@pytest.mark.parametrize(("colour", "depth"), [(c, d) for c, depths in png.DEPTHS.items() for d in depths])
@pytest.mark.parametrize("size", [(1, 1), (9, 13), (3, 2)])
def test_every_kind_of_image_comes_back(colour, depth, interlaced, size):
    rng = np.random.default_rng(depth + colour)
    samples = rng.integers(0, 1 << depth, (*size, png.CHANNELS[colour]))
    palette = rng.integers(0, 256, (1 << min(depth, 8), 3)).astype(np.uint8)
    more = chunk(b"PLTE", palette.tobytes()) if colour == 3 else b""
    image, orientation, clear = png.decode(written(samples, colour, depth, interlaced, more))
    eight = samples >> 8 if depth == 16 else samples if depth == 8 else samples * (255 // ((1 << depth) - 1))
    want = palette[samples[:, :, 0]] if colour == 3 else np.concatenate([np.repeat(eight[:, :, :1], 3, 2), eight[:, :, 1:]], 2) if colour == 4 else eight
    assert orientation == 1 and clear == (colour in (4, 6))
    assert np.array_equal(image, want)


def test_transparent_palettes_and_white_ground():
    palette = chunk(b"PLTE", bytes([0, 0, 0, 10, 20, 30])) + chunk(b"tRNS", b"\x00")
    image, _, clear = png.decode(written(np.array([[[0], [1]]]), 3, 8, more=palette))
    assert clear and pixels.flatten_alpha(image).tolist() == [[[255, 255, 255], [10, 20, 30]]]


def test_any_damage_is_refused():
    samples = np.random.default_rng(1).integers(0, 256, (5, 4, 3))
    whole = written(samples, 2, 8)
    for at in range(len(whole)):
        broken = whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :]
        with pytest.raises(ValueError):
            png.decode(broken)
        with pytest.raises(ValueError):
            png.decode(whole[:at])


def test_data_that_are_too_long_or_short_and_bad_headers_are_refused():
    head = lambda w, h, d=8, c=2: chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, d, c, 0, 0, 0))
    body = lambda raw: chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    for text in (head(1, 1) + body(bytes(3)), head(1, 1) + body(bytes(5)), head(1, 1) + body(b"\x07abc"), head(0, 1) + body(b""), head(1, 1, 4) + body(bytes(4)), head(1, 1, 8, 3) + body(bytes(2)), body(bytes(4)), head(1 << 20, 1 << 20) + body(bytes(4))):
        with pytest.raises(ValueError):
            png.decode(png.SIGNATURE + text)


@pytest.mark.parametrize("order", [">", "<"])
def test_orientations(order):
    seen = np.arange(6).reshape(2, 3, 1)
    stored = {1: seen, 2: seen[:, ::-1], 3: seen[::-1, ::-1], 4: seen[::-1], 5: seen.swapaxes(0, 1), 6: np.rot90(seen, 1), 7: seen[::-1, ::-1].swapaxes(0, 1), 8: np.rot90(seen, -1)}
    for number, image in stored.items():
        found, orientation, _ = png.decode(written(image, 0, 8, more=exif(number, order)))
        assert orientation == number
        assert np.array_equal(png.turned(found, number), seen)
    assert [png.exif_orientation(x) for x in (b"", b"MM\0*", b"II*\0" + bytes(2), b"MM\0*\xff\xff\xff\xff", exif(9, order)[8:-4])] == [1] * 5


def test_canonical_images(spark):
    rng = np.random.default_rng(3)
    big = rng.integers(0, 256, (30, 60, 3))
    files = {"big": written(big, 2, 8), "turned": written(big, 2, 8, more=exif(6)), "clear": written(np.zeros((4, 4, 4), int), 6, 8), "jpeg": b"\xff\xd8\xff", "cut": written(big, 2, 8)[:-20], "none": None}
    df = spark.createDataFrame([(k, None if c is None else bytearray(c), "x") for k, c in files.items()], "file_name string, content binary, ok string")
    rows = {r.file_name: r for r in images.canonical_images(df, longest_side=20).collect()}
    assert {k: r.ok for k, r in rows.items()} == {"big": True, "turned": True, "clear": True, "jpeg": False, "cut": False, "none": False}
    r = rows["big"]
    assert (r.source_width, r.source_height, r.width, r.height, r.scale, r.resample, r.oriented) == (60, 30, 20, 10, 20 / 60, "lanczos", False)
    assert (rows["turned"].source_width, rows["turned"].width, rows["turned"].height, rows["turned"].oriented) == (30, 10, 20, True)
    back, _, _ = png.decode(bytes(r.canonical))
    assert r.sha256 == hashlib.sha256(bytes(r.canonical)).hexdigest() and np.array_equal(back, pixels.lanczos(big, 20, 10))
    assert rows["clear"].alpha_policy == "composite_white" and (png.decode(bytes(rows["clear"].canonical))[0] == 255).all() and rows["clear"].h == -1
    assert rows["jpeg"].problem == "not a PNG" and rows["cut"].sha256 is None and rows["none"].h is None


def test_ingest_takes_the_decoded_files(spark):
    rng = np.random.default_rng(4)
    one = rng.integers(0, 256, (8, 8, 3))
    files = {"a.png": written(one, 2, 8), "b.png": written(one, 2, 8, interlaced=True), "c.png": written(one, 2, 8, more=exif(3)), "d.png": b"no image"}
    decoded = images.canonical_images(spark.createDataFrame([(k, bytearray(c)) for k, c in files.items()], "file_name string, content binary"))
    source = spark.createDataFrame([(k, f"{n}.png") for k, n in enumerate("abcde")], "id long, file_name string")
    ends = {r.file_name: r.reason for r in ingest.outcomes(source, decoded.select("file_name", "ok", "oriented", "sha256", "width", "height", "h")).collect()}
    assert ends == {"a.png": None, "b.png": "duplicate_image", "c.png": "exif_orientation", "d.png": "decode_failed", "e.png": "missing_source"}
