"""Connected components of a table of links, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node in links (a, b): label is the smallest node of its component.

    Rounds of: take the smallest label of all neighbours, then the label of one's label
    (which halves what is left of long chains), until nothing changes. Each round is written
    to the shared folder. Self links and repeated links do no harm; null ends are left out.
    """
    ends = links.filter("a is not null and b is not null")
    both = materialize(ends.select("a", "b").unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        told = labels.join(near, labels.node == near.a, "left").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        told = materialize(told, "labels")
        up = told.select(F.col("node").alias("parent"), F.col("label").alias("higher"))
        labels = materialize(
            told.join(up, told.label == up.parent, "left").select("node", "was", F.coalesce(F.least("label", "higher"), "label").alias("label")), "labels"
        )
        if labels.filter("label <> was").isEmpty():
            return labels.select("node", "label")
        labels = labels.drop("was")
