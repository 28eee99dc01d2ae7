"""Joins of boxes through grid cells: an equality join where a plain one would compare everything with everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import meets, overlaps


def cells(df: DataFrame, size: int, prefix: str = "") -> DataFrame:
    """A row for each cell that the box meets, with cx and cy."""
    at = lambda c: F.floor(F.col(f"{prefix}{c}") / size).cast("bigint")
    return df.withColumn("cx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("cy", F.explode(F.sequence(at("y0"), at("y1"))))


def cell_join(left: DataFrame, right: DataFrame, keys: list[str], size: int, touching: bool = False, how: str = "inner") -> DataFrame:
    """Pairs of rows with equal keys whose boxes (left a_x0.., right b_x0..) share an area, or a point if touching.

    A pair comes from the one cell that holds the lower corner of what both boxes span, so no pair comes twice.
    how: inner or left_semi.
    """
    a = tuple(F.col(f"a_{c}") for c in ("x0", "y0", "x1", "y1"))
    b = tuple(F.col(f"b_{c}") for c in ("x0", "y0", "x1", "y1"))
    near = meets(a, b) if touching else overlaps(a, b)  # type: ignore[arg-type]
    rights = right.withColumnsRenamed({k: f"b_{k}" for k in keys})
    # a box is as many rows as it meets cells, which estimates of size know nothing of: never broadcast, no sorting
    l_cells, r_cells = cells(left, size, "a_"), cells(rights, size, "b_").withColumnsRenamed({"cx": "b_cx", "cy": "b_cy"}).hint("shuffle_hash")
    on = (F.col("cx") == F.col("b_cx")) & (F.col("cy") == F.col("b_cy")) & near
    for k in keys:
        on = on & (F.col(k) == F.col(f"b_{k}"))
    if how == "left_semi":
        return l_cells.join(r_cells, on, "left_semi").drop("cx", "cy").dropDuplicates()
    own = (F.floor(F.greatest("a_x0", "b_x0") / size) == F.col("cx")) & (F.floor(F.greatest("a_y0", "b_y0") / size) == F.col("cy"))
    return l_cells.join(r_cells, on).filter(own).drop("cx", "cy", "b_cx", "b_cy", *(f"b_{k}" for k in keys))


def centre_join(left: DataFrame, right: DataFrame, keys: list[str], size: int, threshold: float) -> DataFrame:
    """Pairs of rows with equal keys whose boxes share an area, at least all pairs of which the IoU is above the threshold (over 0); no pair comes twice.

    A left box is one row, in the cell of its centre; a right box is a row for each cell in which the centre of such a box may lie.
    The IoU is at most what both share of their joint span along either axis, so that, of a right box of width w, a left
    one's centre lies at most w * (1 - threshold) / (2 * threshold) off: within the box where the threshold is a half.
    """
    near = overlaps(tuple(F.col(f"a_{c}") for c in ("x0", "y0", "x1", "y1")), tuple(F.col(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))  # type: ignore[arg-type]
    far = (1 - threshold) / threshold * (1 + 1e-9)  # and a little more, as quotients are rounded
    at = lambda twice: F.floor(twice / (2 * size)).cast("bigint")

    def span(axis: str) -> Column:
        low, high = F.col(f"b_{axis}0"), F.col(f"b_{axis}1")
        return F.explode(F.sequence(at(low + high - (high - low) * far), at(low + high + (high - low) * far)))

    rights = right.withColumnsRenamed({k: f"b_{k}" for k in keys}).withColumn("b_cx", span("x")).withColumn("b_cy", span("y")).hint("shuffle_hash")
    lefts = left.withColumns({f"c{axis}": at(F.col(f"a_{axis}0") + F.col(f"a_{axis}1")) for axis in "xy"})
    on = (F.col("cx") == F.col("b_cx")) & (F.col("cy") == F.col("b_cy")) & near
    for k in keys:
        on = on & (F.col(k) == F.col(f"b_{k}"))
    return lefts.join(rights, on).drop("cx", "cy", "b_cx", "b_cy", *(f"b_{k}" for k in keys))
