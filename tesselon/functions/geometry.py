"""Affine algebra and polygon measures on nested arrays, all as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coefficient(matrix: Column, row: int, col: int) -> Column:
    return F.get(F.get(matrix, F.lit(row)), F.lit(col))


def _six(m: Column) -> tuple[Column, ...]:
    return tuple(coefficient(m, r, c) for r in (0, 1) for c in (0, 1, 2))


def matrix(a: Column, b: Column, tx: Column, c: Column, d: Column, ty: Column) -> Column:
    return F.array(F.array(a, b, tx), F.array(c, d, ty))


def determinant(m: Column) -> Column:
    a, b, _, c, d, _ = _six(m)
    return a * d - b * c


def invert_affine(m: Column, strict: bool = False) -> Column:
    """Inverse of a 2x3 matrix; null for a singular one (|det| < 1e-12), or an error if ``strict``."""
    a, b, tx, c, d, ty = _six(m)
    det = determinant(m)
    found = matrix(d / det, -b / det, (b * ty - d * tx) / det, -c / det, a / det, (c * tx - a * ty) / det)
    singular = F.abs(det) < 1e-12
    other = F.raise_error(F.lit("singular affine matrix")) if strict else F.lit(None)
    return F.when(~singular, found).when(singular, other)


def apply_affine(m: Column, x: Column, y: Column) -> tuple[Column, Column]:
    a, b, tx, c, d, ty = _six(m)
    return a * x + b * y + tx, c * x + d * y + ty


def affine_parts(m: Column) -> dict[str, Column]:
    """``scale_x, scale_y`` (lengths of the images of the unit vectors), ``turn`` of the first in degrees, length of the
    ``shift``, and whether the plane is ``mirrored``; null for a null matrix."""
    a, b, tx, c, d, ty = _six(m)
    return {"scale_x": F.hypot(a, c), "scale_y": F.hypot(b, d), "turn": F.degrees(F.atan2(c, a)), "shift": F.hypot(tx, ty), "mirrored": a * d - b * c < 0}


def compose_affine(first: Column, second: Column) -> Column:
    """The matrix of ``second`` after ``first``."""
    a, b, tx, c, d, ty = _six(first)
    e, f, ux, g, h, uy = _six(second)
    return matrix(e * a + f * c, e * b + f * d, e * tx + f * ty + ux, g * a + h * c, g * b + h * d, g * tx + h * ty + uy)


def warp_rings(m: Column, rings: Column) -> Column:
    """Every vertex of a polygon's rings moved by the matrix."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(*apply_affine(m, F.get(p, F.lit(0)), F.get(p, F.lit(1))))))


def close_ring(ring: Column) -> Column:
    """The first vertex repeated at the end if it isn't there."""
    return F.when((F.size(ring) > 0) & (F.get(ring, F.lit(0)) != F.get(ring, F.size(ring) - 1)), F.concat(ring, F.array(F.get(ring, F.lit(0))))).otherwise(ring)


def open_ring(ring: Column) -> Column:
    closed = (F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1))
    return F.when(closed, F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0)))).otherwise(ring)


def _mean(points: Column, axis: int) -> Column:
    return F.try_divide(F.aggregate(points, F.lit(0.0), lambda s, p: s + F.get(p, F.lit(axis))), F.size(points))


def vertex_centroid(ring: Column) -> tuple[Column, Column]:
    """Mean of the vertices, the closing one left out."""
    points = open_ring(ring)
    return _mean(points, 0), _mean(points, 1)


def signed_area(ring: Column) -> Column:
    """Shoelace area of a closed ring, positive if it turns left; null for a null ring."""
    ends = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda p, q: F.get(p, F.lit(0)) * F.get(q, F.lit(1)) - F.get(q, F.lit(0)) * F.get(p, F.lit(1)))
    return F.aggregate(ends, F.lit(0.0), lambda s, v: s + v) / 2


def bounding_box(ring: Column) -> tuple[Column, Column, Column, Column]:
    axis = lambda k: F.transform(ring, lambda p: F.get(p, F.lit(k)))
    return F.array_min(axis(0)), F.array_min(axis(1)), F.array_max(axis(0)), F.array_max(axis(1))


def oriented(ring: Column, left: bool) -> Column:
    """The ring turned so that it runs to the left (outlines) or right (holes)."""
    area = signed_area(ring)
    return F.when((area < 0) if left else (area > 0), F.reverse(ring)).otherwise(ring)


def by_angle(points: Column) -> Column:
    """Vertices in order of their polar angle about their mean, ties by position."""
    cx, cy = _mean(points, 0), _mean(points, 1)
    keyed = F.transform(points, lambda p: F.struct(F.atan2(F.get(p, F.lit(1)) - cy, F.get(p, F.lit(0)) - cx).alias("t"), p.alias("p")))
    return F.transform(F.array_sort(keyed), lambda s: s["p"])


def mm_to_px(x: Column, y: Column, px_per_mm: float, width: Column, height: Column, stage_x: Column | None = None, stage_y: Column | None = None) -> tuple[Column, Column]:
    """Millimetres to pixels with y flipped, from the stage's corner or else from the image's centre."""
    if stage_x is not None and stage_y is not None:
        return (x - stage_x) * px_per_mm, (stage_y - y) * px_per_mm
    return x * px_per_mm + width / 2, height / 2 - y * px_per_mm


def repaired(ring: Column) -> Column:
    """A ring without null or non-finite corners and corners repeated one after another, closed; null if fewer than three
    different corners are left or its area is 0."""
    number = lambda p, k: F.get(p, F.lit(k))
    usable = F.filter(ring, lambda p: p.isNotNull() & number(p, 0).isNotNull() & number(p, 1).isNotNull() & (F.abs(number(p, 0)) < 1e300) & (F.abs(number(p, 1)) < 1e300))
    apart = F.filter(usable, lambda p, i: (i == 0) | (p != F.get(usable, i - 1)))
    closed = close_ring(apart)
    return F.when((F.size(F.array_distinct(apart)) >= 3) & (signed_area(closed) != 0), closed)


def vertex_columns(ring: Column) -> tuple[Column, Column]:
    """A ring's corners as an array of x and one of y."""
    return F.transform(ring, lambda p: F.get(p, F.lit(0))), F.transform(ring, lambda p: F.get(p, F.lit(1)))


def largest_ring(rings: Column) -> Column:
    """The closed ring of the largest area, the first of several; null without any."""
    keyed = F.transform(rings, lambda r, i: F.struct((-F.abs(signed_area(close_ring(r)))).alias("a"), i.alias("i"), close_ring(r).alias("r")))
    return F.array_min(F.filter(keyed, lambda s: s["a"].isNotNull()))["r"]
