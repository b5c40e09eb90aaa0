"""Box geometry as Column expressions: scaling between coordinate spaces, containment, overlap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coordinate(box: Column, i: int) -> Column:
    return F.get(box, F.lit(i))


def grid(value: Column, size: Column, to: int = 1024) -> Column:
    """Pixel to grid, half to even."""
    return F.bround(value * F.lit(float(to)) / size).cast("int")


def det_to_pixel(value: Column, size: Column) -> Column:
    """A 0..999 coordinate in pixels, truncated."""
    return (value / F.lit(999.0) * size).cast("int")


def box_to_grid(box: Column, w: Column, h: Column, to: int = 1024) -> Column:
    return F.transform(box, lambda v, i: F.when(i % 2 == 0, grid(v, w, to)).otherwise(grid(v, h, to)))


def centre_in(x0: Column, y0: Column, x1: Column, y1: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Whether the centre of the first rectangle is in the second, its border included."""
    return ((x0 + x1) / 2).between(bx0, bx1) & ((y0 + y1) / 2).between(by0, by1)


def mostly_inside(x0: Column, y0: Column, x1: Column, y1: Column, tx0: Column, ty0: Column, tx1: Column, ty1: Column, share: float = 0.5) -> Column:
    """Whether more than a share of the first rectangle's area is in the second."""
    width = F.least(x1, tx1) - F.greatest(x0, tx0)
    height = F.least(y1, ty1) - F.greatest(y0, ty0)
    return (width >= 0) & (height >= 0) & (width * height > F.lit(share) * (x1 - x0) * (y1 - y0))


def polygon_box(poly: Column) -> Column:
    """Bounding box of x, y, x, y, ... ."""
    xs, ys = F.filter(poly, lambda _, i: i % 2 == 0), F.filter(poly, lambda _, i: i % 2 == 1)
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
