"""Joins by an ordered list of rules: the first rule that finds anything decides, and its first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import shuffle_tasks


def ranked_rule_join(left: DataFrame, right: DataFrame, left_id: str, rules: list[tuple[str, Column, Column]], order: list[Column], payload: list[str]) -> DataFrame:
    """Left rows with the payload of their match, rule (null without a match) and n_matches under that rule.

    rules: (name, key of left, key of right); null keys match nothing. The candidates of all
    rules come from one join on (rule, key). Rows become as many as there are rules, which estimates of size know nothing of:
    small files are dealt out first, and neither side is broadcast.
    """
    tasks = shuffle_tasks(left.sparkSession)
    left, right = left.repartition(tasks, left_id), right.repartition(tasks, *order)
    lefts = left.select("*", F.explode(F.array(*(F.struct(F.lit(k).alias("rank"), a.alias("key")) for k, (_, a, _) in enumerate(rules)))).alias("lk"))
    rights = right.select(*payload, *(o.alias(f"order_{k}") for k, o in enumerate(order)), F.explode(F.array(*(F.struct(F.lit(k).alias("rank"), b.alias("key")) for k, (_, _, b) in enumerate(rules)))).alias("rk"))
    rights = rights.filter("rk.key is not null").select("rk.rank", "rk.key", *payload, *(f"order_{k}" for k in range(len(order))))
    found = lefts.filter("lk.key is not null").select(left_id, "lk.rank", "lk.key").repartition(tasks, "rank", "key").join(rights.repartition(tasks, "rank", "key").hint("merge"), ["rank", "key"])
    w = Window.partitionBy(left_id)
    best = found.withColumn("place", F.row_number().over(w.orderBy("rank", *(f"order_{k}" for k in range(len(order))))))
    best = best.withColumn("first", F.min("rank").over(w))
    best = best.withColumn("n_matches", F.sum((F.col("rank") == F.col("first")).cast("int")).over(w)).filter("place = 1")
    names = F.element_at(F.array(*(F.lit(n) for n, _, _ in rules)), F.col("rank") + 1)
    return left.join(best.select(left_id, *payload, names.alias("rule"), "n_matches").hint("merge"), left_id, "left")
