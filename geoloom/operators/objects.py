"""Matching predicted with annotated objects, one to one, best overlap first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import area, box
from .durable import Held
from .spatial_join import cell_join, centre_join

CELL = 64


def iou_pairs(predictions: DataFrame, annotations: DataFrame, threshold: float, cell: int = CELL) -> DataFrame:
    """(scene, pid, gid, iou) of pairs with an IoU above the threshold; empty boxes take no part."""
    whole = (F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))
    pick = lambda df, i, p: df.filter(whole).select("scene", i, *(F.col(c).alias(f"{p}{c}") for c in ("x0", "y0", "x1", "y1")))
    sides = pick(predictions, "pid", "a_"), pick(annotations, "gid", "b_")
    pairs = centre_join(*sides, ["scene"], cell, threshold) if 0 < threshold < 1 else cell_join(*sides, ["scene"], cell)
    # Pairs share an area (no matter in which order the join asks for that and the IoU), so that iou()'s cases need not be told apart: with these the join's code, which has the IoU twice, exceeds the 8,000 bytes that the JVM compiles.
    wide, high = (F.least(f"a_{c}1", f"b_{c}1") - F.greatest(f"a_{c}0", f"b_{c}0") for c in "xy")
    common = (wide * high).cast("double")
    union = (area(box("a_")) + area(box("b_"))).cast("double") - common
    return pairs.select("scene", "pid", "gid", F.try_divide(common, union).alias("iou")).filter(F.col("iou") > threshold)


def greedy_match(pairs: DataFrame) -> DataFrame:
    """(scene, pid, gid, iou) of a one-to-one matching: pairs by falling IoU, then pid, then gid, each taken if both ends are free.

    In rounds: a pair that is the best left of both its ends is taken, whatever is done elsewhere, and pairs with a taken end
    go. The best pair left is always one of these, so the rounds end, with what taking pairs one by one gives. The first
    round deals all pairs by one end and then by the other, and takes those whose ends have no other pair; only contested pairs go on,
    each round a few joins over the pairs left. Rounds are written to the shared folder; no scene has to fit into a task.
    """
    held = Held(pairs.sparkSession, "pairs")
    rank = F.struct((-F.round("iou", 12)).alias("a"), F.col("pid").alias("b"), F.col("gid").alias("c"))
    of = {end: Window.partitionBy("scene", end) for end in ("pid", "gid")}
    told = pairs.repartition("scene", "pid").groupBy("scene", "pid", "gid").agg(F.max("iou").alias("iou"))  # repeated pairs count once
    for end, w in of.items():
        told = told.withColumns({f"best_{end}": F.min(rank).over(w) == rank, f"n_{end}": F.count(F.lit(1)).over(w)})
    alone = (F.col("n_pid") == 1) & (F.col("n_gid") == 1)
    told = held.put(told.select("scene", "pid", "gid", "iou", alone.alias("alone"), (F.col("best_pid") & F.col("best_gid")).alias("best")))
    pair = ("scene", "pid", "gid", "iou")
    taken, told = [told.filter("alone").select(*pair)], told.filter("not alone").select(*pair, "best")
    while True:
        won = told.filter("best").select(*pair)
        if won.isEmpty():
            break
        taken.append(won)
        left = told.filter("not best").select(*pair)
        for end in of:
            left = left.join(won.select("scene", end), ["scene", end], "left_anti")
        told = held.put(left.select(*pair, ((F.min(rank).over(of["pid"]) == rank) & (F.min(rank).over(of["gid"]) == rank)).alias("best")))
    return reduce(DataFrame.unionByName, taken)


def scene_counts(predictions: DataFrame, annotations: DataFrame, matches: DataFrame) -> DataFrame:
    """(scene, tp, fp, fn) for all scenes that either side has."""
    n = lambda df, name: df.groupBy("scene").agg(F.count(F.lit(1)).alias(name))
    both = n(predictions, "preds").join(n(annotations, "gts"), "scene", "full_outer").join(n(matches, "tp"), "scene", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    return both.select("scene", zero("tp").alias("tp"), (zero("preds") - zero("tp")).alias("fp"), (zero("gts") - zero("tp")).alias("fn"))


def kept_by_area(area: Column, least: float) -> Column:
    """Objects smaller than least go."""
    return F.coalesce(area, F.lit(0)) >= least
