"""Boxes, windows, affine transforms and coordinate systems as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))  # type: ignore[return-value]


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def overlaps(a: Box, b: Box) -> Column:
    """Boxes share an area; touching is not enough."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def meets(a: Box, b: Box) -> Column:
    """Boxes share at least a point."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def intersection_area(a: Box, b: Box) -> Column:
    width, height = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((width > 0) & (height > 0), width * height).otherwise(F.lit(0))


def iou(a: Box, b: Box) -> Column:
    common = intersection_area(a, b)
    union = area(a) + area(b) - common
    return F.when(union > 0, common.cast("double") / union.cast("double")).otherwise(F.lit(0.0))


def distance(a: Box, b: Box) -> Column:
    """Shortest distance of two boxes; 0 where they meet."""
    dx = F.greatest(a[0] - b[2], b[0] - a[2], F.lit(0))
    dy = F.greatest(a[1] - b[3], b[1] - a[3], F.lit(0))
    return F.sqrt((dx * dx + dy * dy).cast("double"))


def side(anchor: Box, other: Box) -> Column:
    """Where the other box's centre lies from the anchor's; y grows upwards."""
    dx = (other[0] + other[2] - anchor[0] - anchor[2]) / 2
    dy = (other[1] + other[3] - anchor[1] - anchor[3]) / 2
    return F.when(F.abs(dx) >= F.abs(dy), F.when(dx >= 0, "right").otherwise("left")).otherwise(F.when(dy >= 0, "top").otherwise("bottom"))


def affine_point(affine: list[Column], x: Column, y: Column) -> tuple[Column, Column]:
    a, b, c, d, e, f = affine
    return a * x + b * y + c, d * x + e * y + f


def window_bounds(affine: list[Column], b: Box) -> Box:
    """Bounds in the raster's system of a window given in pixels."""
    corners = [affine_point(affine, x, y) for x in (b[0], b[2]) for y in (b[1], b[3])]
    xs, ys = [p[0] for p in corners], [p[1] for p in corners]
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


#: Fixed value: radius of the sphere of EPSG:3857, in metres.
EARTH_RADIUS = 6_378_137.0


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:4326 to EPSG:3857."""
    return F.radians(lon) * EARTH_RADIUS, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH_RADIUS


def inferred_crs(largest_absolute: Column) -> Column:
    return F.when(largest_absolute > 1000, F.lit("EPSG:3857")).otherwise(F.lit("EPSG:4326"))


def epsg_code(text: Column) -> Column:
    """EPSG:n of a coordinate system's name or URN; null if it has none."""
    code = F.regexp_extract(text, r"(?i)EPSG(?::+|/)(?:[\d.]*:)?(\d+)", 1)
    return F.when(code != "", F.concat(F.lit("EPSG:"), code))


def pixel_units(affine: list[Column], pixels: float) -> Column:
    """A distance in pixels in the raster's units, by the longer of a pixel's sides."""
    a, b, _, d, e, _ = affine
    return pixels * F.greatest(F.hypot(a, d), F.hypot(b, e), F.lit(1e-9))
