"""Train and validation splits, caps and samples, in an order by md5 that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(seed: int, *cols: Column | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols)))


def prefix_split(rows: DataFrame, order: list[str], fraction: float, up: bool, *keys: str) -> DataFrame:
    """Adds `part`: the first share of each group's rows is train, the rest val; up rounds the share up. With one row it is in both."""
    w = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(w)
    cut = (F.ceil if up else F.floor)(n * fraction)
    told = rows.withColumn("part", F.when(F.row_number().over(w.orderBy(*order)) <= F.greatest(cut, F.lit(1)), "train").otherwise("val"))
    return told


def cap_empty_share(rows: DataFrame, is_empty: Column, share: float, seed: int, *keys: str) -> DataFrame:
    """Empty rows are cut to at most floor(share * filled / (1 - share)) of each group, chosen by hash order."""
    told = rows.withColumn("is_empty", is_empty)
    w = Window.partitionBy(*keys)
    filled = F.sum((~F.col("is_empty")).cast("bigint")).over(w)
    # tenths of percents, so that the bound is an integer operation
    mille = round(share * 1000)
    bound = F.expr(f"({mille} * filled_rows) div {1000 - mille}")
    placed = told.withColumns({"filled_rows": filled, "place": F.row_number().over(Window.partitionBy(*keys, "is_empty").orderBy(hash_order(seed, *keys, "rid")))})
    return placed.filter(~F.col("is_empty") | (F.col("place") <= bound)).drop("filled_rows", "place")


def cap_rows(rows: DataFrame, is_empty: Column, most: int, seed: int, *keys: str) -> DataFrame:
    """At most so many rows of each group, filled ones first, then by hash order."""
    w = Window.partitionBy(*keys).orderBy(is_empty.cast("int"), hash_order(seed, *keys, "rid"))
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).drop("place")


def balanced_slots(rows: DataFrame, kinds: dict[str, int], seed: int, *keys: str) -> DataFrame:
    """(keys, kind, slot, rid): for each group and kind so many slots, each filled by a row of that kind, with replacement."""
    w = Window.partitionBy(*keys, "kind")
    numbered = rows.withColumns({"k": F.row_number().over(w.orderBy("rid")) - 1, "n": F.count(F.lit(1)).over(w)})
    sizes = numbered.groupBy(*keys, "kind").agg(F.max("n").alias("n"))
    want = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in kinds.items()), F.lit(0))
    slots = sizes.withColumn("slot", F.explode(F.sequence(F.lit(1), want))) if all(kinds.values()) else sizes.filter(want > 0).withColumn("slot", F.explode(F.sequence(F.lit(1), want)))
    pick = F.conv(F.substring(hash_order(seed, *keys, "kind", "slot"), 1, 8), 16, 10).cast("bigint") % F.col("n")
    return slots.withColumn("k", pick).drop("n").join(numbered.drop("n"), [*keys, "kind", "k"]).select(*keys, "kind", "slot", "rid")


def object_balanced_split(
    counts: DataFrame, fraction: float = 0.2, seed: int = 42, with_empty: bool = True, target_objects: int | None = None, min_scenes: int | None = None
) -> DataFrame:
    """counts (dataset, scene, objects) with `part`: val has about the share of objects, and of scenes without objects.

    Scenes are gone through by falling object count (ties by hash): the first that is not
    larger than the target opens val, and others join while they fit into the target or bring val's objects nearer to
    it, or val has under min_scenes scenes. target_objects, if given, takes the place of the share of objects. Where nothing is chosen, the last
    scene goes to val. Sizes decide scene by scene, so each dataset's scenes are folded in order, as one array of numbers.
    """
    rows = counts.withColumn("h", hash_order(seed, "dataset", "scene"))
    item = F.struct((-F.col("objects")).alias("minus"), "h", "scene", "objects")
    sets = rows.groupBy("dataset").agg(F.array_sort(F.collect_list(F.when(F.col("objects") > 0, item))).alias("some"), F.array_sort(F.collect_list(F.when(F.col("objects") <= 0, F.struct("h", "scene")))).alias("none"), F.sum("objects").alias("total"), F.count(F.lit(1)).alias("n"), F.max("scene").alias("last"))
    aim = F.rint(F.col("total") * fraction).cast("bigint") if target_objects is None else F.lit(target_objects).cast("bigint")
    target = F.when(F.col("total") > 0, F.greatest(F.lit(1), aim)).otherwise(F.lit(0).cast("bigint"))
    least = F.when(F.col("n") > 1, max(1, min_scenes or 1)).otherwise(1)
    sets = sets.withColumn("target", target).withColumn("fits", F.exists("some", lambda s: s["objects"] <= F.col("target")))

    def step(state: Column, s: Column) -> Column:
        have, aim = state["have"], F.col("target")
        opened = F.size(state["val"]) > 0
        too_big = ~opened & (s["objects"] > aim) & F.exists(F.col("some"), lambda o: (o["objects"] <= aim) & (o > s))
        fits = have + s["objects"] <= aim
        nearer = F.abs(aim - have - s["objects"]) <= F.abs(aim - have)
        enough = F.size(state["val"]) >= least
        stop = (have >= aim) & enough
        take = F.when(opened, ~stop & (((have < aim) & fits) | nearer | ~enough)).otherwise(~too_big)
        return F.struct(
            F.when(take, have + s["objects"]).otherwise(have).alias("have"),
            F.when(take, F.concat(state["val"], F.array(s["scene"]))).otherwise(state["val"]).alias("val"),
        )

    kind = counts.schema["scene"].dataType.simpleString()
    start = F.struct(F.lit(0).cast("bigint").alias("have"), F.array().cast(f"array<{kind}>").alias("val"))
    zeros = F.rint(F.size("none") * F.lit(fraction)).cast("int")
    zeros = F.when((F.size("none") > 0) & (F.col("n") > 1), F.greatest(zeros, F.lit(1))).otherwise(zeros) if with_empty else F.lit(0)
    chosen = sets.withColumn("val", F.aggregate("some", start, step)["val"]).withColumn("zeros", F.transform(F.slice("none", 1, zeros), lambda z: z["scene"]))
    chosen = chosen.withColumn("val", F.concat("val", "zeros"))
    chosen = chosen.withColumn("val", F.when((F.size("val") == 0) & (F.col("n") > 1), F.array("last")).otherwise(F.col("val")))
    # not everything may go to val: an empty scene, else the largest, comes back
    back = F.coalesce(F.try_element_at("zeros", F.lit(1)), F.try_element_at("val", F.lit(1)))
    chosen = chosen.withColumn("val", F.when((F.size("val") == F.col("n")) & (F.col("n") > 1), F.array_remove("val", back)).otherwise(F.col("val")))
    return counts.join(chosen.select("dataset", F.explode("val").alias("scene"), F.lit("val").alias("part")), ["dataset", "scene"], "left").withColumn("part", F.coalesce("part", F.lit("train")))


#: The settings that may limit a dataset's scenes, the most preferred first, and the reasons' settings.
LIMIT_KEYS = ("max_dataset_scenes", "dataset_limit", "scene_limit", "sample_size", "max_scenes")
REASON_KEYS = ("dataset_limit_reason", "limit_reason")


def dataset_limit(raw: Column, config: Column) -> Column:
    """Struct (value, source, reason) of the first limit that is set in maps of settings, as given before those of the configuration."""
    set_ = lambda k: F.nullif(F.coalesce(raw[k], config[k]), F.lit(""))
    told = lambda m, k: F.nullif(m[k], F.lit(""))
    given = F.coalesce(*(told(m, k) for m in (raw, config) for k in REASON_KEYS))
    struct = lambda value, source, reason: F.struct(value.alias("value"), source.alias("source"), reason.alias("reason"))
    out = struct(F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    for k in reversed(LIMIT_KEYS):
        usual = "preprocess.max_scenes compatibility limit" if k == "max_scenes" else "explicit dataset input limit configured"
        limit = F.greatest(F.lit(1), set_(k).cast("int"))
        out = F.when(set_(k).isNotNull(), struct(limit, F.lit(f"pipeline_trace.preprocess.{k}"), F.coalesce(given, F.lit(usual)))).otherwise(out)
    return out


def input_invariant(matched: Column, listed: Column, selected: Column, limit: Column) -> Column:
    """(The texts are fixed values.) Whether a dataset's scenes are those of its inventory, or fewer by a stated limit."""
    return (
        F.when(matched != listed, F.lit("FAILED: inventory matched_count does not match matched scene rows"))
        .when(limit.isNotNull(), F.lit("OK with explicit limit"))
        .when(selected == matched, F.lit("OK"))
        .otherwise(F.lit("FAILED: selected scenes differ from inventory without explicit dataset limit"))
    )
