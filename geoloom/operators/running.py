"""Running sums over a whole table, without one task that sees all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .durable import Held


def running_sum(rows: DataFrame, order: str, value: str, into: str = "total") -> DataFrame:
    """rows with the sum of value over all rows up to each, by order (rows of equal order share theirs).

    Rows are dealt out in ranges and written; a range's sum starts where the ranges before it end. Those carried
    totals are one row a range, as many as shuffle partitions, and broadcast.
    """
    held = Held(rows.sparkSession, "ranges")
    ranged = held.put(rows.repartitionByRange(order).withColumn("range_id", F.spark_partition_id()))
    sums = ranged.groupBy("range_id").agg(F.sum(value).alias("part"))
    carried = sums.select("range_id", (F.sum("part").over(Window.orderBy("range_id")) - F.col("part")).alias("carried"))
    within = F.sum(value).over(Window.partitionBy("range_id").orderBy(order))
    return ranged.join(F.broadcast(carried), "range_id").withColumn(into, F.col("carried") + within).drop("range_id", "carried")
