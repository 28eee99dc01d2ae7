"""Tile candidates: footprints, annotations, classes, hard negatives, neighbours, mosaics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from .polygons import covered_area
from .spatial_join import cell_join

CELL = 256


def named(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    return df.select(*keep, *(F.col(c).alias(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")))


def annotated_windows(windows: DataFrame, annotations: DataFrame) -> DataFrame:
    """windows (scene, index, x0..y1) with objects and mask_area: annotations that share an area with them, and how much."""
    pairs = cell_join(named(windows, "a_", "scene", "index"), named(annotations, "b_", "scene", "gid"), ["scene"], CELL)
    shared = G.intersection_area(G.box("a_"), G.box("b_"))
    told = pairs.groupBy("scene", "index").agg(F.count(F.lit(1)).alias("objects"), F.sum(shared).alias("mask_area"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return windows.join(told, ["scene", "index"], "left").select(*(windows[c] for c in windows.columns), zero("objects"), zero("mask_area"))


def tile_kind(mask_area: Column, area: Column, full: float = 0.5) -> Column:
    """positive from a share of annotated pixels on, partial with fewer, negative with none."""
    return F.when(mask_area == 0, "negative").when(mask_area >= area * full, "positive").otherwise("partial")


def hard_negatives(windows: DataFrame, annotations: DataFrame, context: int) -> DataFrame:
    """Empty windows that meet an annotation's box grown by context; touching is enough."""
    grown = annotations.select("scene", (F.col("x0") - context).alias("b_x0"), (F.col("y0") - context).alias("b_y0"), (F.col("x1") + context).alias("b_x1"), (F.col("y1") + context).alias("b_y1"))
    empty = windows.filter("objects = 0").select("scene", "index", *(F.col(c).alias(f"a_{c}") for c in ("x0", "y0", "x1", "y1")))
    return cell_join(empty, grown, ["scene"], CELL, touching=True, how="left_semi").select("scene", "index")


def footprint_share(windows: DataFrame, footprints: DataFrame) -> DataFrame:
    """windows with share (of their area inside the scene's footprint), and inside from 0.999 on; windows outside are gone."""
    both = named(windows, "a_", "scene", "index").join(named(footprints, "b_", "scene"), "scene").filter(G.overlaps(G.box("a_"), G.box("b_")))
    share = G.intersection_area(G.box("a_"), G.box("b_")) / G.area(G.box("a_"))
    return both.select("scene", "index", share.alias("share"), (share >= 0.999).alias("inside"))


def adjacency(footprints: DataFrame, touch: int, near: int, cell: int) -> DataFrame:
    """Ordered pairs of scenes that overlap, touch (at most `touch` apart) or are near: relation, side, area, distance, cover.

    Boxes are grown by half of the largest distance and joined through cells, so that only neighbours are compared.
    """
    reach = max(touch, near)
    grow = lambda df, p: df.select(
        *(F.col(c).alias(f"{p[0]}{c}") for c in ("scene", "x0", "y0", "x1", "y1")), F.lit(1).alias("all"),
        (F.col("x0") - reach).alias(f"{p}x0"), (F.col("y0") - reach).alias(f"{p}y0"), F.col("x1").alias(f"{p}x1"), F.col("y1").alias(f"{p}y1"),
    )
    pairs = cell_join(grow(footprints, "a_"), grow(footprints, "b_"), ["all"], cell, touching=True).filter("ascene <> bscene")
    a, b = (tuple(F.col(f"{p}{c}") for c in ("x0", "y0", "x1", "y1")) for p in "ab")
    shared, apart = G.intersection_area(a, b), G.distance(a, b)  # type: ignore[arg-type]
    relation = F.when(shared > 0, "overlap").when(apart <= touch, "touch").when(apart <= reach, "near")
    side = F.when(shared > 0, "overlap").otherwise(G.side(a, b))  # type: ignore[arg-type]
    told = pairs.select(F.col("ascene").alias("anchor"), F.col("bscene").alias("neighbour"), relation.alias("relation"), side.alias("side"), shared.cast("bigint").alias("area"), F.round(apart, 6).alias("distance"), F.round(shared / G.area(a), 9).alias("cover"))  # type: ignore[arg-type]
    return told.filter("relation is not null")


def mosaic_plan(windows: DataFrame, footprints: DataFrame, edges: DataFrame) -> DataFrame:
    """Whether windows (anchor scene, index, world box) that stick out of their footprint can be filled by its neighbours.

    gap: the area outside the footprint; reason: fully_inside_footprint (from a share of 0.999 on), neighbor_covers_gap or
    no_neighbor_for_gap; candidates: neighbours with a share of the gap; side: that of the first of them (overlapping, then touching, then
    near ones, by distance); cover: the share of the gap that they cover together, however they overlap; overlap: an overlapping neighbour
    meets the window.
    """
    key = ["scene", "index"]
    corners = ("x0", "y0", "x1", "y1")
    own = named(windows, "a_", *key).join(named(footprints, "b_", "scene"), "scene")
    inside = G.intersection_area(G.box("a_"), G.box("b_"))
    gaps = own.withColumns({"gap": G.area(G.box("a_")) - inside, "full": inside / G.area(G.box("a_")) >= 0.999})
    told_of = {"relation": "string", "side": "string", "distance": "double"}  # edges may say no more than who is whose neighbour
    said = [F.col(c) if c in edges.columns else F.lit(None).cast(kind).alias(c) for c, kind in told_of.items()]
    near = edges.select(F.col("anchor").alias("scene"), "neighbour", *said).join(footprints.select(F.col("scene").alias("neighbour"), *(F.col(c).alias(f"c_{c}") for c in corners)), "neighbour")
    reach = gaps.filter("not full").select(*key, *(f"{p}_{c}" for p in "ab" for c in corners)).join(near, "scene")
    part = {c: (F.greatest if c.endswith("0") else F.least)(f"a_{c}", f"c_{c}") for c in corners}
    reach = reach.withColumns({f"p_{c}": x for c, x in part.items()}).filter("p_x1 >= p_x0 and p_y1 >= p_y0")
    rank = F.struct(F.when(F.col("relation") == "overlap", 0).when(F.col("relation") == "touch", 1).otherwise(2), "distance", "neighbour")
    of_gap = G.area(G.box("p_")) - G.intersection_area(G.box("p_"), G.box("b_"))
    told = reach.withColumn("of_gap", of_gap)
    found = told.groupBy(*key).agg(F.count_if(F.col("of_gap") > 0).alias("candidates"), F.min_by("side", F.when(F.col("of_gap") > 0, rank)).alias("side"), F.bool_or(F.coalesce(F.col("relation") == "overlap", F.lit(False))).alias("overlap"))
    # what candidates and footprint cover together, less the footprint
    clipped = {c: (F.greatest if c.endswith("0") else F.least)(f"a_{c}", f"b_{c}") for c in corners}
    held = gaps.filter("not full").select(*key, *(x.alias(c) for c, x in clipped.items())).filter("x1 > x0 and y1 > y0")
    boxes = told.filter("of_gap > 0").select(*key, *(F.col(f"p_{c}").alias(c) for c in corners)).unionByName(held)
    covered = covered_area(boxes, key).withColumnRenamed("area", "covered")
    reason = F.when(F.col("full"), "fully_inside_footprint").when(F.col("candidates") > 0, "neighbor_covers_gap").otherwise("no_neighbor_for_gap")
    share = F.when(F.col("candidates") > 0, F.least((F.col("covered") - inside) / F.col("gap"), F.lit(1.0))).otherwise(0.0)
    whole = gaps.join(found, key, "left").join(covered, key, "left")
    return whole.select(
        *key, F.col("gap").cast("bigint").alias("gap"), reason.alias("reason"), F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("side", F.lit("unknown")).alias("side"),
        F.round(share, 9).alias("cover"), F.coalesce("overlap", F.lit(False)).alias("overlap"),
    )
