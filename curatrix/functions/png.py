"""Reading and writing PNG images as numpy arrays: checked chunks, row filters, interlacing, the EXIF orientation.

What is not a whole, undamaged PNG raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: The signature, channels of each colour type and the depths it may have, the passes of an interlaced image
#: (first column, first row, step across, step down), and the EXIF tag of the orientation.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
ORIENTATION = 274
#: Images of more pixels are refused before they are inflated: one must fit into a task.
MAX_PIXELS = 100_000_000


def chunks(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(type, data) of each chunk up to the end of the image."""
    if not content.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    at = len(SIGNATURE)
    while True:
        if at + 12 > len(content):
            raise ValueError("the file ends inside a chunk")
        (size,) = struct.unpack_from(">I", content, at)
        body = content[at + 4 : at + 8 + size]
        end = at + 8 + size
        if end + 4 > len(content) or zlib.crc32(body) != struct.unpack_from(">I", content, end)[0]:
            raise ValueError("a chunk is cut off or damaged")
        yield body[:4], body[4:]
        if body[:4] == b"IEND":
            return
        at = end + 4


def unfiltered(data: bytes, rows: int, row_bytes: int, step: int) -> np.ndarray:
    """The bytes of ``rows`` rows; ``step`` bytes on a row belong to the pixel before."""
    out = np.zeros((rows + 1, row_bytes), np.uint8)
    table = np.frombuffer(data, np.uint8).reshape(rows, row_bytes + 1)
    for k in range(rows):
        kind, row, above = int(table[k, 0]), table[k, 1:], out[k]
        if kind == 0:
            out[k + 1] = row
        elif kind == 1:
            padded = np.zeros(-(-row_bytes // step) * step, np.uint8)
            padded[:row_bytes] = row
            out[k + 1] = np.cumsum(padded.reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:row_bytes]
        elif kind == 2:
            out[k + 1] = row + above
        elif kind in (3, 4):
            values, up, made = row.tolist(), above.tolist(), [0] * step
            for i, value in enumerate(values):
                left = made[i]
                if kind == 3:
                    guess = (left + up[i]) // 2
                else:
                    corner = up[i - step] if i >= step else 0
                    near = left + up[i] - corner
                    a, b, c = abs(near - left), abs(near - up[i]), abs(near - corner)
                    guess = left if a <= b and a <= c else up[i] if b <= c else corner
                made.append((value + guess) & 255)
            out[k + 1] = made[step:]
        else:
            raise ValueError("unknown row filter")
    return out[1:]


def _samples(rows: np.ndarray, width: int, depth: int, channels: int) -> np.ndarray:
    """rows x width x channels of whole samples."""
    if depth == 16:
        wide = rows.reshape(len(rows), -1, 2)
        values = wide[:, :, 0].astype(np.uint16) << 8 | wide[:, :, 1]
    elif depth == 8:
        values = rows
    else:
        bits = np.unpackbits(rows, axis=1).reshape(len(rows), -1, depth)
        values = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(2).astype(np.uint8)
    return values[:, : width * channels].reshape(len(rows), width, channels)


def exif_orientation(exif: bytes) -> int:
    """The orientation (1 to 8) that EXIF data name; 1 if they name none."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(exif[:4])
    if order is None or len(exif) < 8:
        return 1
    (at,) = struct.unpack_from(f"{order}I", exif, 4)
    if at + 2 > len(exif):
        return 1
    (n,) = struct.unpack_from(f"{order}H", exif, at)
    for k in range(n):
        if at + 2 + 12 * (k + 1) > len(exif):
            return 1
        tag, kind, count, value = struct.unpack_from(f"{order}HHIH", exif, at + 2 + 12 * k)
        if tag == ORIENTATION:
            return value if kind == 3 and count == 1 and 1 <= value <= 8 else 1
    return 1


def turned(image: np.ndarray, orientation: int) -> np.ndarray:
    """An image as its orientation says that it is to be seen."""
    if orientation in (5, 6, 7, 8):
        image = image.swapaxes(0, 1)
    if orientation in (3, 4, 7, 8):
        image = image[::-1]
    if orientation in (2, 3, 6, 7):
        image = image[:, ::-1]
    return image


def decode(content: bytes) -> tuple[np.ndarray, int, bool]:
    """(height x width x channels of 8 bits, EXIF orientation, whether it has transparency to lay on a background).

    Palettes are looked up, with an alpha channel if any entry is transparent; of 16 bits the upper eight stay, fewer
    than eight are spread. A single transparent colour of an image without an alpha channel is not transparency.
    """
    head = palette = alpha = None
    data, exif = [], b""
    for kind, body in chunks(content):
        if head is None and kind != b"IHDR":
            raise ValueError("the header is missing")
        if kind == b"IHDR":
            if head is not None or len(body) != 13:
                raise ValueError("the header is damaged")
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            if len(body) % 3 or not body:
                raise ValueError("the palette is damaged")
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            alpha = np.frombuffer(body, np.uint8)
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"eXIf":
            exif = body
    width, height, depth, colour, packing, filtering, interlaced = head or (0,) * 7
    if not width or not height or depth not in DEPTHS.get(colour, ()) or packing or filtering or interlaced > 1 or (colour == 3 and palette is None):
        raise ValueError("the header is damaged")
    if width * height > MAX_PIXELS:
        raise ValueError(f"more than {MAX_PIXELS} pixels")
    channels = CHANNELS[colour]
    step = max(1, depth * channels // 8)
    parts = [(0, 0, 1, 1)] if not interlaced else PASSES
    sizes = [(-(-(width - x) // dx) if width > x else 0, -(-(height - y) // dy) if height > y else 0) for x, y, dx, dy in parts]
    row_bytes = [-(-w * depth * channels // 8) for w, _ in sizes]
    total = sum((b + 1) * h for b, (w, h) in zip(row_bytes, sizes, strict=True) if w and h)
    reader = zlib.decompressobj()
    try:
        raw = reader.decompress(b"".join(data), total + 1)
    except zlib.error as e:
        raise ValueError("the data are damaged") from e
    if len(raw) != total:
        raise ValueError("there are not as many data as pixels")
    image = np.zeros((height, width, channels), np.uint16 if depth == 16 else np.uint8)
    at = 0
    for (x, y, dx, dy), (w, h), wide in zip(parts, sizes, row_bytes, strict=True):
        if w and h:
            size = (wide + 1) * h
            image[y::dy, x::dx] = _samples(unfiltered(raw[at : at + size], h, wide, step), w, depth, channels)
            at += size
    if colour == 3:
        if int(image.max()) >= len(palette):
            raise ValueError("a pixel has no colour in the palette")
        if alpha is not None:
            full = np.full(len(palette), 255, np.uint8)
            full[: len(alpha)] = alpha[: len(palette)]
            palette = np.column_stack([palette, full])
        return palette[image[:, :, 0]], exif_orientation(exif), alpha is not None
    if depth == 16:
        image = (image >> 8).astype(np.uint8)
    elif depth < 8:
        image = image * np.uint8(255 // ((1 << depth) - 1))
    if colour == 4:
        image = np.concatenate([np.repeat(image[:, :, :1], 3, 2), image[:, :, 1:]], axis=2)
    return image, exif_orientation(exif), colour in (4, 6)


def encode(image: np.ndarray) -> bytes:
    """A height x width x 3 image of 8 bits as a PNG without row filters."""
    height, width, _ = image.shape
    rows = np.zeros((height, 3 * width + 1), np.uint8)
    rows[:, 1:] = image.reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")
