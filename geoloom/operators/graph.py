"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import Held


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): the smallest node of its component.

    Each round hangs a node's root under the least root around it, then takes the root's root, so that chains
    shorten by half; it ends when nothing changes. Rounds are written to the shared folder, and older ones deleted.
    """
    held = Held(links.sparkSession, "links")
    both = held.put(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    rounds = Held(links.sparkSession, "roots")
    roots = rounds.put(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"), F.lit(True).alias("moved")))
    while not roots.filter("moved").isEmpty():
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        told = rounds.put(roots.join(near, roots.node == near.a, "left").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root")))
        up = told.select(F.col("node").alias("parent"), F.col("root").alias("higher"))
        root = F.coalesce(F.least("root", "higher"), "root")
        roots = rounds.put(told.join(up, told.root == up.parent, "left").select("node", root.alias("root"), (root < F.col("was")).alias("moved")))
        rounds.drop(keep=1)
    held.drop()
    return roots.select("node", "root")
