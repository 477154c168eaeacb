"""Geometry as column expressions (GEO): no Python runs on rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_triangle_attributes(faces: DataFrame) -> DataFrame:
    """area, unit normal (nx, ny, nz; zero for a degenerate triangle) and centroid (cx, cy, cz) of x0..z2."""
    c = F.col
    kx = (c("y1") - c("y0")) * (c("z2") - c("z0")) - (c("z1") - c("z0")) * (c("y2") - c("y0"))
    ky = (c("z1") - c("z0")) * (c("x2") - c("x0")) - (c("x1") - c("x0")) * (c("z2") - c("z0"))
    kz = (c("x1") - c("x0")) * (c("y2") - c("y0")) - (c("y1") - c("y0")) * (c("x2") - c("x0"))
    length = F.sqrt(kx * kx + ky * ky + kz * kz)
    unit = lambda k: F.when(length > 1e-12, k / length).otherwise(0.0)
    return faces.withColumns({"area": length / 2, "nx": unit(kx), "ny": unit(ky), "nz": unit(kz), **{f"c{a}": (c(f"{a}0") + c(f"{a}1") + c(f"{a}2")) / 3 for a in "xyz"}})


def affine(matrix: list[float], x: Column, y: Column, z: Column, metres: float = 1.0) -> list[Column]:
    """Row-major 4x4 matrix times a point, then the unit's scale."""
    return [(x * matrix[4 * i] + y * matrix[4 * i + 1] + z * matrix[4 * i + 2] + matrix[4 * i + 3]) * metres for i in range(3)]


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 when either has no length."""
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s.cast("double") * t.cast("double")), F.lit(0.0), lambda s, t: s + t)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def in_sector(dx: Column, dy: Column, z: Column, fx: Column, fy: Column, radius: float, half_deg: float, low: Column, high: Column) -> Column:
    """Within the radius, the angle about the forward direction and the height range; the anchor itself has no direction."""
    d = F.hypot(dx, dy)
    along = F.when(d > 1e-9, (dx * fx + dy * fy) / d).otherwise(0.0)
    return (d <= radius) & (along >= math.cos(math.radians(half_deg))) & (z >= low) & (z <= high)


def intrinsics(width: Column, fov_x: Column, height: Column, fov_y: Column) -> list[Column]:
    """fx, fy, cx, cy of a pinhole camera from its fields of view in degrees."""
    return [width * 0.5 / F.tan(F.radians(fov_x) / 2), height * 0.5 / F.tan(F.radians(fov_y) / 2), width / 2, height / 2]


def unproject(row: Column, col: Column, dist: Column, fx: Column | float, fy: Column | float, cx: Column | float, cy: Column | float) -> list[Column]:
    """Camera-space point at a distance along a pixel's ray."""
    rx, ry = (col + 0.5 - cx) / fx, -(row + 0.5 - cy) / fy
    size = F.sqrt(rx * rx + ry * ry + 1)
    return [rx / size * dist, ry / size * dist, F.lit(-1.0) / size * dist]


def rigid_inverse(m: Column) -> Column:
    """Inverse of a row-major 4x4 matrix of a rotation and a shift: the rotation turned over, and the shift turned back."""
    rows = [[m[i], m[4 + i], m[8 + i], -(m[i] * m[3] + m[4 + i] * m[7] + m[8 + i] * m[11])] for i in range(3)]
    return F.array(*(c for r in rows for c in r), *map(F.lit, (0.0, 0.0, 0.0, 1.0)))


def barycentric(u: Column, v: Column) -> list[Column]:
    """Weights of the three corners; (u, v) beyond the diagonal is reflected."""
    over = u + v > 1
    a, b = F.when(over, 1 - u).otherwise(u), F.when(over, 1 - v).otherwise(v)
    return [1 - a - b, a, b]


def orientations(dx: Column, dy: Column, dz: Column) -> Column:
    """Six array entries (up_axis, extent, score) of a box: each axis up and down, scored by height over footprint."""
    out = []
    for axis, (a, b, up) in (("Z", (dx, dy, dz)), ("X", (dy, dz, dx)), ("Y", (dz, dx, dy))):
        score = up / F.sqrt(F.greatest(a * b, F.lit(1e-12)))
        out += [F.struct(F.lit(sign + axis).alias("up_axis"), up.alias("height"), score.alias("score")) for sign in "+-"]
    return F.array(*out)


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance in XY of a point from a segment."""
    dx, dy = bx - ax, by - ay
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-12))))
    return F.hypot(px - (ax + t * dx), py - (ay + t * dy))
