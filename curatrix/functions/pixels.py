"""Pixel kernels on numpy arrays of height x width x 3, applied by Arrow functions row by row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the grey of a letterbox's border.
BORDER = 114


def _taps(size: int, out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-pixel sampling with clamped edges: (left index, right index, share of the right one)."""
    at = np.clip((np.arange(out) + 0.5) * size / out - 0.5, 0, size - 1).astype(np.float32)
    low = np.floor(at).astype(np.int64)
    return low, np.minimum(low + 1, size - 1), (at - low).astype(np.float32)


def stretch(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear resize to float32, values not rounded."""
    y0, y1, fy = _taps(image.shape[0], height)
    x0, x1, fx = _taps(image.shape[1], width)
    pixels = image.astype(np.float32)
    rows = pixels[y0] * (1 - fy)[:, None, None] + pixels[y1] * fy[:, None, None]
    return rows[:, x0] * (1 - fx)[None, :, None] + rows[:, x1] * fx[None, :, None]


def tensor(image: np.ndarray, width: int, height: int, scale: float, mean: list[float], std: list[float], bgr: bool = False, channels_last: bool = False) -> np.ndarray:
    """The model's input: resized, channels ordered, ``(p * scale - mean) / std``, one image a batch."""
    pixels = stretch(image, width, height)
    pixels = pixels[:, :, ::-1] if bgr else pixels
    values = (pixels * np.float32(scale) - np.asarray(mean, np.float32)) / np.asarray(std, np.float32)
    return np.ascontiguousarray(values if channels_last else values.transpose(2, 0, 1))[None].astype(np.float32)


def letterbox(image: np.ndarray, width: int, height: int) -> tuple[np.ndarray, int, int, float]:
    """(padded image, left, top, ratio): the image scaled to fit, centred on grey."""
    ratio = min(width / image.shape[1], height / image.shape[0])
    w, h = max(1, round(image.shape[1] * ratio)), max(1, round(image.shape[0] * ratio))
    out = np.full((height, width, 3), BORDER, np.float32)
    left, top = (width - w) // 2, (height - h) // 2
    out[top : top + h, left : left + w] = np.rint(stretch(image, w, h))
    return out, left, top, ratio


def lanczos(image: np.ndarray, width: int, height: int, lobes: int = 3) -> np.ndarray:
    """Windowed-sinc resize to uint8; shrinking widens the window."""

    def matrix(size: int, out: int) -> np.ndarray:
        step = max(1.0, size / out)
        centre = (np.arange(out) + 0.5) * size / out
        x = (np.arange(size)[None] + 0.5 - centre[:, None]) / step
        w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0.0)
        return w / w.sum(1, keepdims=True)

    rows = np.tensordot(matrix(image.shape[0], height), image.astype(np.float64), (1, 0))
    out = np.tensordot(matrix(image.shape[1], width), rows, (1, 1)).transpose(1, 0, 2)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def grey_thumbnail(image: np.ndarray, side: int = 8) -> np.ndarray:
    """A side x side grey image by means over areas, for the average hash."""
    grey = image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])
    bounds = lambda n: [(k * n // side, max((k + 1) * n // side, k * n // side + 1)) for k in range(side)]
    return np.array([[grey[a:b, c:d].mean() for c, d in bounds(grey.shape[1])] for a, b in bounds(grey.shape[0])])


def flatten_alpha(image: np.ndarray) -> np.ndarray:
    """Three channels of an image with one, three or four: grey repeated, transparency laid on white."""
    if image.ndim == 2:
        return np.repeat(image[:, :, None], 3, 2)
    if image.shape[2] == 4:
        alpha = image[:, :, 3:].astype(np.float32) / 255
        return np.rint(image[:, :, :3] * alpha + 255 * (1 - alpha)).astype(np.uint8)
    return np.repeat(image[:, :, :1], 3, 2) if image.shape[2] < 3 else image[:, :, :3]


def tensors(frames: DataFrame, width: int, height: int, scale: float, mean: list[float], std: list[float], bgr: bool = False, channels_last: bool = False, id_col: str = "frame") -> DataFrame:
    """(frame, tensor array<float>) from (frame, width, height, pixels binary), three bytes a pixel, row by row.

    Frames whose bytes do not fill their size raise.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = [tensor(np.frombuffer(p, np.uint8).reshape(h, w, 3), width, height, scale, mean, std, bgr, channels_last).ravel() for w, h, p in zip(part.width, part.height, part.pixels, strict=True)]
            yield pd.DataFrame({id_col: part[id_col], "tensor": made})

    kind = frames.schema[id_col].dataType.simpleString()
    return frames.select(id_col, "width", "height", "pixels").mapInPandas(run, f"{id_col} {kind}, tensor array<float>")


def thumbnail_hash_input(width: Column, height: Column, pixels: Column) -> Column:
    """The 64 grey values of an image column, for ``functions.hashes.average_hash``."""

    @F.pandas_udf("array<double>")
    def thumb(w: pd.Series, h: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([grey_thumbnail(np.frombuffer(b, np.uint8).reshape(y, x, 3)).ravel().tolist() for x, y, b in zip(w, h, p, strict=True)])

    return thumb(width, height, pixels)
