"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed random order, gone through at most
MOST_PASSES times. A copy's virtual finish time is the number of its source's words up to and
including it, divided by the source's target. All copies are sorted by finish time and taken
from the front until the budget is spent, so that at every point of the mix each source has
had its share.

Both orders, within sources and of all copies, are made by range partitioning, so that nothing is gathered by
source or by id, of which one may hold most rows: rows with equal keys are told apart by their row key, at which
ranges can be cut too. The totals of ranges, a small table, are summed up; then running totals are taken
within ranges. Of the globally sorted copies, ranges before the end of the budget are taken
whole, and the one in which it ends is gone through in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, row_key, word_count

#: Weights that sources get in turn, in code point order, and the budget as a share of all words.
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MOST_PASSES = 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_percent: int = BUDGET_PERCENT, most_passes: int = MOST_PASSES) -> DataFrame:
    """source, source_size, target for a table of one row per source (source, source_size).

    The budget is shared by weight; a target stops at most_passes times its source's size, and
    what that leaves over is shared among the others by weight. Sources stop in the order of
    cap over weight: the first k do if the k-th's cap is below its share of what the
    first k - 1 left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # a row per source
    ranked = sizes.withColumn("k", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("long")
    weighted = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most_passes)
    by_cap = Window.orderBy(F.col("cap") * F.lit(1.0) / F.col("weight"), "k")
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = weighted.select(
        "*",
        (F.sum("source_size").over(everything) * budget_percent).alias("budget_100"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("w_left"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
    )
    # cap * w_left <= weight * (budget - caps before), in exact integers (hundredths of words)
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    stops = exact("cap") * 100 * exact("w_left") <= exact("weight") * (exact("budget_100") - exact("cap_before") * 100)
    marked = left.withColumn("stops", stops)
    rest = marked.select(
        "*",
        (F.max("budget_100").over(everything) - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everything), F.lit(0)) * 100).alias("rest_100"),
        F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything).alias("w_rest"),
    )
    share = F.col("weight").cast("double") * F.col("rest_100").cast("double") / F.lit(100.0) / F.col("w_rest").cast("double")
    return rest.select("source", "source_size", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _ranged(rows: DataFrame, label: str, *order: Column | str) -> DataFrame:
    """rows, written in ranges of an order, with the number of the range each is in (`part`)."""
    return materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), label)


def schedule(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, row_col: str | None = None
) -> DataFrame:
    """One row per document: rid, doc_id, source, size, source_size, target, h, cum (its source's words up to it).

    The order within a source is by h, a hash of seed, id and text, then id, then rid.
    """
    docs, rid = (docs, F.col(row_col)) if row_col else row_key(docs)
    h = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    rows = docs.select(rid.alias("rid"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), h.alias("h"))
    rows = _ranged(materialize(rows, "mix-rows"), "mix-order", F.col("source").asc_nulls_last(), "h", "doc_id", "rid")
    totals = materialize(rows.groupBy("source", "part").agg(F.sum("size").alias("n")), "mix-ranges")  # one row for each range and source in it
    aims = targets(totals.groupBy("source").agg(F.sum("n").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("before"))
    starts = starts.alias("s").join(aims.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source"))).select("s.*", "a.source_size", "a.target")
    within = Window.partitionBy("part", "source").orderBy("h", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("local", F.sum("size").over(within))
    met = local.alias("l").join(starts.alias("s"), (F.col("l.part") == F.col("s.part")) & F.col("l.source").eqNullSafe(F.col("s.source")))
    return met.select("l.rid", "l.doc_id", "l.source", "l.size", "l.h", "s.source_size", "s.target", (F.col("before") + F.col("local")).alias("cum"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, row_col: str | None = None
) -> DataFrame:
    """One row per row of docs: rid, doc_id, source, size, source_size, target, taken (words), copies (0 to 2), finish (of the first copy).

    Whole documents are taken, in the order of finish time (ties by h, then rid, then copy), as long as their
    words fit into the budget. Null text: size 0; such documents never cost words, taken is 0. A null source is a
    source of its own, last in order. Rows with equal or null ids are told apart by rid: row_col, which must be the same in
    every job, or a key drawn here. Empty input: empty result. Other columns are not read.
    """
    planned = materialize(schedule(docs, id_col, text_col, source_col, seed, row_col), "mix-schedule")
    passes = F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1)))
    finish = (F.col("cum") + F.col("source_size") * F.col("copy")).cast("double") / F.col("target")
    queue = planned.filter("size > 0 and target > 0").select("rid", "h", "size", "target", "cum", "source_size", passes.alias("copy")).withColumn("finish", finish)
    order = ["finish", "h", "rid", "copy"]
    queue = _ranged(queue.select("size", *order), "mix-queue", *order)
    budget = (planned.agg(F.sum("size")).first()[0] or 0) * BUDGET_PERCENT // 100
    end, before = -1, 0
    for r in queue.groupBy("part").agg(F.sum("size").alias("n")).orderBy("part").collect():  # one row for each range
        end = r.part
        if before + r.n > budget:
            break
        before += r.n
    else:
        end += 1
    upto = F.sum("size").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    last = queue.filter(F.col("part") == end).withColumn("upto", upto).filter(F.col("upto") <= budget - before)
    taken = queue.filter(F.col("part") < end).select("rid", "size").unionByName(last.select("rid", "size"))
    counts = taken.groupBy("rid").agg(F.sum("size").alias("taken"), F.count(F.lit(1)).cast("int").alias("copies"))
    return planned.join(counts, "rid", "left").select(
        "rid", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("copies", F.lit(0)).alias("copies"),
        F.when(F.col("target") > 0, F.col("cum").cast("double") / F.col("target")).alias("finish"),
    )
