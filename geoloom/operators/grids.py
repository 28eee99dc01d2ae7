"""Window grids, block grids and which tiles a block needs, without joining every tile with every block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grids import axis_origins


def window_grid(scenes: DataFrame, tile: int, stride: int, clip: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Windows (scene, x, y, width, height, index, is_edge) of scenes (scene, w, h), numbered row by row.

    clip: windows end at the scene's edge, else they keep their size and may hang over. keep: which of w and h come along.
    """
    xs, ys = axis_origins(F.col("w"), tile, stride), axis_origins(F.col("h"), tile, stride)
    rows = scenes.select("scene", "w", "h", F.size(xs).alias("nx"), xs.alias("xs"), F.posexplode(ys).alias("yi", "y"))
    cells = rows.select("scene", "w", "h", "nx", "yi", "y", F.posexplode("xs").alias("xi", "x"))
    edge = (F.col("x") == 0) | (F.col("y") == 0) | (F.col("x") + tile >= F.col("w")) | (F.col("y") + tile >= F.col("h"))
    width = F.least(F.lit(tile), F.col("w") - F.col("x")) if clip else F.lit(tile)
    height = F.least(F.lit(tile), F.col("h") - F.col("y")) if clip else F.lit(tile)
    return cells.select(
        "scene", "x", "y", width.cast("bigint").alias("width"), height.cast("bigint").alias("height"), (F.col("yi") * F.col("nx") + F.col("xi")).cast("bigint").alias("index"), edge.alias("is_edge"), *keep
    )


def block_grid(scenes: DataFrame, core: int, halo: int) -> DataFrame:
    """Blocks: a core of core x core pixels, and the core grown by halo but not beyond the scene."""
    steps = lambda n: F.sequence(F.lit(0).cast("bigint"), (F.ceil(F.col(n) / core) - 1).cast("bigint"))
    cells = scenes.select("scene", "w", "h", F.explode(steps("h")).alias("bi"), steps("w").alias("ws")).select("scene", "w", "h", "bi", F.explode("ws").alias("bj"))
    x0, y0 = F.col("bj") * core, F.col("bi") * core
    x1, y1 = F.least(x0 + core, F.col("w")), F.least(y0 + core, F.col("h"))
    zero = F.lit(0).cast("bigint")
    return cells.select(
        "scene", "bi", "bj", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"),
        F.greatest(x0 - halo, zero).alias("ex0"), F.greatest(y0 - halo, zero).alias("ey0"), F.least(x1 + halo, F.col("w")).alias("ex1"), F.least(y1 + halo, F.col("h")).alias("ey1"),
    )


def block_tiles(blocks: DataFrame, windows: DataFrame, core: int, halo: int) -> DataFrame:
    """(scene, bi, bj, index): tiles that share an area with a block's grown box.

    Each tile tells by arithmetic which blocks it can reach, so this is a linear
    explode and an equality join on (scene, bi, bj), not a join by ranges.
    """

    def reach(start: Column, size: Column) -> Column:
        # blocks with index i have the grown span [i * core - halo, (i + 1) * core + halo)
        low = F.greatest(F.floor((start - halo) / core).cast("bigint"), F.lit(0).cast("bigint"))
        high = F.floor((start + size - 1 + halo) / core).cast("bigint")
        return F.sequence(low, high)

    spread = windows.select("scene", "index", "x", "y", "width", "height", F.explode(reach(F.col("y"), F.col("height"))).alias("bi"))
    spread = spread.withColumn("bj", F.explode(reach(F.col("x"), F.col("width"))))
    met = (F.col("x") < F.col("ex1")) & (F.col("ex0") < F.col("x") + F.col("width")) & (F.col("y") < F.col("ey1")) & (F.col("ey0") < F.col("y") + F.col("height"))
    # blocks are made from far fewer scenes, which estimates of size know nothing of: never broadcast
    return spread.join(blocks.hint("merge"), ["scene", "bi", "bj"]).filter(met).select("scene", "bi", "bj", "index")


def batches(rows: DataFrame, order: list[str], partition: list[str], size: int) -> DataFrame:
    """Adds `batch`: rows numbered within partition, so many to a batch."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1
    return rows.withColumn("batch", F.floor(place / size).cast("bigint"))


def repeats(rows: DataFrame, factor: Column) -> DataFrame:
    """Each row `factor` times (at least once) with repeat_index; source of repeats is `virtual_repeat`."""
    out = rows.withColumn("repeat_index", F.explode(F.sequence(F.lit(0), F.greatest(factor, F.lit(1)) - 1)))
    return out.withColumn("source", F.when(F.col("repeat_index") > 0, F.lit("virtual_repeat")).otherwise(F.col("source")))


def repeats_by_kind(rows: DataFrame, positive: int, hard_negative: int, negative: int) -> DataFrame:
    """repeats() of tiles (base_record_id, kind, source) by their kind, with record_id; what is not repeated has no repeat_index."""
    kind = F.col("kind")
    factor = F.when(kind.isin("positive", "partial_positive"), positive).when(kind == "hard_negative", hard_negative).otherwise(negative)
    base, k, many = F.col("base_record_id"), F.col("repeat_index"), factor > 1
    named = F.when(many, F.concat(base, F.lit(":repeat"), k.cast("string"))).otherwise(base)
    return repeats(rows, factor).withColumns({"record_id": named, "repeat_index": F.when(many, k)})
