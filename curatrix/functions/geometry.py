"""Boxes as columns. A box is four columns, or an array ``[x1, y1, x2, y2]``, in pixels from the top left."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Short sides under this are small; boxes may leave the frame by this much when converted.
SMALL_SIDE, FRAME_TOLERANCE = 32.0, 0.5


@dataclass(frozen=True)
class Box:
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @staticmethod
    def of(array: Column) -> Box:
        return Box(*(F.get(array, F.lit(k)) for k in range(4)))

    @staticmethod
    def named(prefix: str = "") -> Box:
        return Box(*(F.col(prefix + c).cast("double") for c in ("x1", "y1", "x2", "y2")))

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def sides(self) -> tuple[Column, ...]:
        return self.x1, self.y1, self.x2, self.y2


def is_finite(x: Column) -> Column:
    """Neither null nor NaN nor infinite. Spark orders NaN above all numbers, so box rules ask this first."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def all_finite(box: Box) -> Column:
    a, b, c, d = map(is_finite, box.sides)
    return a & b & c & d


def inverted(box: Box) -> Column:
    return (box.x1 >= box.x2) | (box.y1 >= box.y2)


def out_of_bounds(box: Box, width: Column, height: Column) -> Column:
    """Outside the frame; a null width or height bounds nothing."""
    beyond = F.coalesce(box.x2 > width, F.lit(False)) | F.coalesce(box.y2 > height, F.lit(False))
    return (box.x1 < 0) | (box.y1 < 0) | beyond


def box_rules(box: Box, width: Column, height: Column) -> Column:
    """The names of the rules that a box breaks; a box that is not four finite numbers breaks box_shape alone."""
    broken = F.array_compact(F.array(F.when(inverted(box), "box_inverted"), F.when(out_of_bounds(box, width, height), "box_out_of_bounds")))
    return F.when(all_finite(box), broken).otherwise(F.array(F.lit("box_shape")))


def from_xywh(x: Column, y: Column, w: Column, h: Column, scale: Column) -> Box:
    x, y, w, h = (c.cast("double") for c in (x, y, w, h))
    return Box(x * scale, y * scale, (x + w) * scale, (y + h) * scale)


def clipped(box: Box, width: Column, height: Column) -> Box:
    def into(value: Column, most: Column) -> Column:
        return F.least(F.greatest(value, F.lit(0.0)), most.cast("double"))

    return Box(into(box.x1, width), into(box.y1, height), into(box.x2, width), into(box.y2, height))


def _array(box: Box) -> Column:
    return F.array(*box.sides)


def representable(x: Column, y: Column, w: Column, h: Column, scale: Column, width: Column, height: Column) -> Column:
    """A source box (corner and size) scaled and clipped into its frame, as array; null if it is not
    finite, has no area before clipping, or leaves the frame by more than the tolerance."""
    box = from_xywh(x, y, w, h, scale)
    near = (box.x1 >= -FRAME_TOLERANCE) & (box.y1 >= -FRAME_TOLERANCE) & (box.x2 <= width + FRAME_TOLERANCE) & (box.y2 <= height + FRAME_TOLERANCE)
    return F.when(all_finite(box) & (box.width > 0) & (box.height > 0) & near, _array(clipped(box, width, height)))


def inverse_stretch(box: Box, from_width: Column, from_height: Column, width: Column, height: Column) -> Column:
    """A box of the stretched input back in the image, clipped, as array; null without area after that.

    Raises for boxes that are not finite or are inverted.
    """
    cut = _unstretched(box, from_width, from_height, width, height)
    return _if_sound(box, F.when((cut.width > 0) & (cut.height > 0), _array(cut)))


def unstretched(box: Box, from_width: Column, from_height: Column, width: Column, height: Column) -> Column:
    """``inverse_stretch`` before it looks at the area: each side is computed once, so that a step which asks for the area of
    what this gave stays small enough for the JVM to compile."""
    return _if_sound(box, _array(_unstretched(box, from_width, from_height, width, height)))


def _unstretched(box: Box, from_width: Column, from_height: Column, width: Column, height: Column) -> Box:
    back = Box(box.x1 * width / from_width, box.y1 * height / from_height, box.x2 * width / from_width, box.y2 * height / from_height)
    return clipped(back, width, height)


def _if_sound(box: Box, value: Column) -> Column:
    good = all_finite(box) & ~(box.x2 < box.x1) & ~(box.y2 < box.y1)
    return F.when(good, value).otherwise(F.raise_error(F.lit("invalid tensor box")).cast("array<double>"))


def inverse_letterbox(box: Box, left: Column, top: Column, ratio: Column, width: Column, height: Column) -> Column:
    """A box of the padded input back in the image, clipped, as array; null without area."""
    cut = clipped(Box((box.x1 - left) / ratio, (box.y1 - top) / ratio, (box.x2 - left) / ratio, (box.y2 - top) / ratio), width, height)
    return F.when((cut.width > 0) & (cut.height > 0), _array(cut))


def normalised(box: Box, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """(centre x, centre y, width, height) as shares of the image."""
    return (box.x1 + box.x2) / (2 * width), (box.y1 + box.y2) / (2 * height), box.width / width, box.height / height


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union is not positive."""
    across = F.greatest(F.lit(0.0), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1))
    down = F.greatest(F.lit(0.0), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1))
    both = across * down
    union = a.width * a.height + b.width * b.height - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def is_small(box: Box, side: float = SMALL_SIDE) -> Column:
    return F.least(box.width, box.height) < side


def downscaled(width: Column, height: Column, longest: int) -> tuple[Column, Column, Column]:
    """(scale, width, height) with the longest side at most ``longest``; halves round to even, never up to more."""
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(width, height))
    sides = [F.greatest(F.lit(1), F.bround(side * scale).cast("int")) for side in (width, height)]
    return scale, *sides
