"""Window grids as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def axis_origins(length: Column, tile: int, stride: int) -> Column:
    """Origins of windows along an axis: every stride, and one that ends at the axis' end; [0] where one window covers it all."""
    last = length - tile
    steps = F.sequence(F.lit(0).cast("bigint"), F.greatest(last, F.lit(0)).cast("bigint"), F.lit(stride).cast("bigint"))
    return F.when(last <= 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_sort(F.array_distinct(F.concat(steps, F.array(last.cast("bigint"))))))


def effective_stride(stride: int, factor: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(stride) * factor).cast("int"))


def ramp(i: Column, n: Column, low: float = 0.05) -> Column:
    """Weight of the i-th of n pixels: from low at both ends up to 1 in the middle's direction, linear from either end."""
    up = low + (1 - low) * i / F.greatest(n - 1, F.lit(1))
    down = low + (1 - low) * (n - 1 - i) / F.greatest(n - 1, F.lit(1))
    return F.when(n <= 1, F.lit(low)).otherwise(F.least(up, down))


def insert_margin(at_edge: Column, margin: int) -> Column:
    """Pixels cut from a window's side: none at the scene's edge."""
    return F.when(at_edge, F.lit(0)).otherwise(F.lit(margin))
