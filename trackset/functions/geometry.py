"""Geometry of inclusive pixel boxes as column expressions.

A box is named by a prefix: `a.` for columns a.xmin, a.ymin, a.xmax, a.ymax, or nothing; or it is a struct column. Frame
sizes are numbers or columns, since videos differ in size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("xmin", "ymin", "xmax", "ymax")


Box = str | Column
Length = int | Column


def _of(box: Box) -> tuple[Column, ...]:
    return tuple(F.col(f"{box}{side}") if isinstance(box, str) else box[side] for side in SIDES)


def _number(x: Length) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("double")


def area(prefix: Box = "") -> Column:
    x0, y0, x1, y1 = _of(prefix)
    return (x1 - x0 + 1) * (y1 - y0 + 1)


def intersection(a: Box, b: Box) -> Column:
    ax0, ay0, ax1, ay1 = _of(a)
    bx0, by0, bx1, by1 = _of(b)
    wide = F.least(ax1, bx1) - F.greatest(ax0, bx0) + 1
    high = F.least(ay1, by1) - F.greatest(ay0, by0) + 1
    zero = F.lit(0).cast("long")
    return F.greatest(zero, wide) * F.greatest(zero, high)


def iou(a: Box, b: Box) -> Column:
    shared = intersection(a, b)
    union = area(a) + area(b) - shared
    return F.when(union == 0, 0.0).otherwise(shared.cast("double") / F.nullif(union, F.lit(0)))


def covered(a: Box, b: Box) -> Column:
    """The share of a that b covers."""
    return intersection(a, b).cast("double") / area(a)


def edge_touches(width: Length, height: Length, tol: int, prefix: Box = "") -> Column:
    """How many borders of the frame the box lies on, within `tol` pixels."""
    x0, y0, x1, y1 = _of(prefix)
    on = (x0 <= tol, y0 <= tol, x1 >= width - 1 - tol, y1 >= height - 1 - tol)
    return sum((c.cast("long") for c in on[1:]), on[0].cast("long"))


def contains(outer: Box, inner: Box, least_inside: float = 0.9, most_area: float = 0.25) -> Column:
    """The inner box lies almost inside the outer and is small beside it."""
    inside = intersection(outer, inner).cast("double") / area(inner) >= least_inside
    return (area(inner) > 0) & inside & (area(inner) <= most_area * area(outer))


def centre(prefix: Box = "") -> tuple[Column, Column]:
    x0, y0, x1, y1 = _of(prefix)
    return (x0 + x1) / F.lit(2.0), (y0 + y1) / F.lit(2.0)


def relative_centre(width: Length, height: Length, prefix: Box = "") -> tuple[Column, Column]:
    x, y = centre(prefix)
    return x / _number(width), y / _number(height)


def relative_box(width: Length, height: Length, prefix: Box = "") -> Column:
    x0, y0, x1, y1 = _of(prefix)
    w, h = _number(width), _number(height)
    return F.array(x0 / w, y0 / h, x1 / w, y1 / h)


def diagonal(prefix: Box = "") -> Column:
    x0, y0, x1, y1 = _of(prefix)
    return F.hypot((x1 - x0 + 1).cast("double"), (y1 - y0 + 1).cast("double"))
