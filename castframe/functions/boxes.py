"""Columns over boxes, labels and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from castframe.schema import LABEL_FORMAT, LABEL_RAISE, LABEL_TOP

CORNERS = ("x1", "y1", "x2", "y2")


def pack_box(*corners: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in zip(CORNERS, corners)])


def unpack_box(box: str, prefix: str = "face_") -> list[Column]:
    return [F.col(f"{box}.{name}").alias(prefix + name) for name in CORNERS]


def is_drawable(*corners: Column) -> Column:
    """Every corner is a number that has a whole pixel."""
    known = F.lit(True)
    for corner in corners:
        known = known & corner.isNotNull() & ~F.isnan(corner) & whole_pixels(corner).isNotNull()
    return known


def whole_pixels(value: Column) -> Column:
    """Truncated toward zero; NULL for what no pixel can have."""
    return value.try_cast("int")


def match_label(name: Column, score: Column) -> Column:
    return F.format_string(LABEL_FORMAT, name, score)


def label_row(y1: Column) -> Column:
    return F.greatest(y1 - LABEL_RAISE, F.lit(LABEL_TOP))


def relative_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """``[x, y, w, h]`` as fractions of the image size."""
    return F.array(*[F.try_divide(a, b) for a, b in ((x1, width), (y1, height), (x2 - x1, width), (y2 - y1, height))])
