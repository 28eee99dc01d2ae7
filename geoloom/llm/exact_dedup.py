"""Exact deduplication by deterministic block naming.

Every text is cut into fixed-size byte blocks. Equal blocks get one integer name, by
sorting the blocks of each hash bucket and taking the dense rank; then adjacent names are
paired and the pairs named the same way, again and again, until each text has one name.
Names are equal exactly when texts are: no step compares digests.

Blocks that make up a large share of all rows (copies of one text) would meet in one sort.
Those frequent blocks are few by construction (a block is frequent if it is more than
1/MAX_FREQUENT of all), so they are named first, in a table of at most MAX_FREQUENT rows of
at most block_bytes each, which is broadcast; their rows are never shuffled. Blocks that are rarer than that,
but have more than WARM rows, are named once each, after partial aggregation, and their names joined back, in a join
whose large keys can be split; so no sort ever holds more than WARM rows of one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, buckets_for, materialize, row_key

BLOCK_BYTES = 16_384
#: Bound of the broadcast table of frequent blocks: 1,000 x 16 KB.
MAX_FREQUENT = 1_000
#: Blocks that occur fewer times than this are never treated as frequent.
LEAST_FREQUENT = 64
#: Most rows of one block that are sorted together. At most one block in so many is warm, which bounds the set of their hashes.
WARM = 100_000
#: A name is bucket * 2**RANK_BITS + rank; frequent blocks have negative names.
RANK_BITS = 40


def _named(items: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Adds `name`: equal for equal keys within items, unique otherwise; sorts each hash bucket."""
    bucketed = items.withColumn("bucket", bucket_of(buckets, *keys))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*keys)).cast("long")
    return bucketed.withColumn("name", F.col("bucket") * F.lit(1 << RANK_BITS) + rank).drop("bucket")


def _blocks(docs: DataFrame, rid: Column, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), data.alias("data"), F.sha2(data, 256).alias("text_sha256"), rid.alias("rid"))
    last = F.greatest(F.octet_length("data") - 1, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), F.floor(last / block_bytes).cast("int")), lambda i: F.substring(F.col("data"), i * block_bytes + 1, F.lit(block_bytes)))
    return rows.select("rid", "doc_id", "text_sha256", cut.alias("cut")).select(
        "rid", "doc_id", "text_sha256", F.size("cut").alias("n_blocks"), F.posexplode("cut").alias("pos", "block")
    )


def _first_names(blocks: DataFrame, buckets: int, warm_rows: int) -> DataFrame:
    spark = blocks.sparkSession
    seen = materialize(blocks.groupBy(F.xxhash64("block").alias("h")).count(), "block-counts")
    total = seen.agg(F.sum("count")).first()[0] or 0
    least = max(LEAST_FREQUENT, total // MAX_FREQUENT)
    often = seen.filter(F.col("count") > min(least, warm_rows)).collect()  # at most MAX_FREQUENT, and one block in WARM
    keep = ["rid", "doc_id", "text_sha256", "n_blocks", "pos", "name"]
    if not often:
        return _named(blocks, ["block"], buckets).select(keep)
    marks = F.broadcast(spark.createDataFrame([(r.h, r["count"] > least) for r in often], "h long, hot boolean"))
    told = blocks.withColumn("h", F.xxhash64("block")).join(marks, "h", "left").drop("h")
    out = [_named(told.filter("hot is null"), ["block"], buckets)]
    if any(r["count"] > least for r in often):
        order = Window.orderBy("block")  # at most MAX_FREQUENT rows
        names = told.filter("hot").select("block").distinct().select("block", (-F.row_number().over(order).cast("long")).alias("name"))
        out.append(told.filter("hot").join(F.broadcast(materialize(names, "frequent-blocks")), "block"))
    if any(r["count"] <= least for r in often):
        warm = told.filter("not hot")
        out.append(warm.join(materialize(_named(warm.select("block").distinct(), ["block"], buckets), "warm-blocks").hint("merge"), "block"))
    rows = out[0].select(keep)
    for more in out[1:]:
        rows = rows.unionByName(more.select(keep))
    return rows


def name_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, row_col: str | None = None, warm_rows: int = WARM
) -> DataFrame:
    """One row per row of docs: rid, doc_id, text_sha256, n_blocks, name.

    Two rows have equal texts exactly if their (n_blocks, name) are equal. A null text counts
    as empty and has one empty block; other columns of docs are not read. rid tells rows apart: row_col, which
    must be the same in every job, or a key drawn here.
    """
    docs, rid = (docs, F.col(row_col)) if row_col else row_key(docs)
    blocks = _blocks(docs, rid, id_col, text_col, block_bytes)
    buckets = buckets_for(docs, 32 << 20, 1024)
    level = materialize(_first_names(blocks, buckets, warm_rows), "block-names")
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    done = [level.filter("n_blocks = 1").drop("pos")]
    level = level.filter("n_blocks > 1")
    while most > 1:
        half = F.expr("cast(pos div 2 as int)")
        pairs = level.groupBy("rid", "doc_id", "text_sha256", "n_blocks", half.alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"), F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right")
        )
        pairs = materialize(pairs.withColumn("right", F.coalesce("right", F.lit(0).cast("long"))), "block-pairs")  # no block is named 0
        names = _named(pairs.select("left", "right").distinct(), ["left", "right"], buckets)
        level = materialize(pairs.join(names, ["left", "right"]).select("rid", "doc_id", "text_sha256", "n_blocks", "pos", "name"), "block-names")
        most = (most + 1) // 2
    return done[0].unionByName(level.drop("pos"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, row_col: str | None = None, warm_rows: int = WARM
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, rid.

    Of rows with equal texts, that with the largest id stays. Null text: as empty. Null id:
    smallest, so it stays only if the whole group has none (keep_id is then null). Rows with
    equal id and text: all counted, one stays. rid tells rows apart (see name_texts). Empty input: empty result. Other
    columns of docs, whatever their names, are neither read nor returned.
    """
    named = name_texts(docs, id_col, text_col, block_bytes, row_col, warm_rows)
    groups = named.groupBy("n_blocks", "name").agg(F.max(F.struct("doc_id", "rid")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups, "text-groups")  # so that the join below has exchanges of its own, which can be split where a group is large
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("last.rid")).alias("kept"), "text_sha256", "rid"
    )
