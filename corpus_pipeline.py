"""A training corpus from `documents`: quality rules, exact and near deduplication, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import quality_rules
from geoloom.llm.byte_bpe import encode_texts
from geoloom.llm.common import documents, free_name, materialize, row_key
from geoloom.llm.exact_dedup import exact_duplicates
from geoloom.llm.mixing import mix
from geoloom.llm.near_dedup import near_duplicates


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with one more column, and its name: a key that tells rows apart, also equal ones, and is the same in every job."""
    docs_, key = row_key(docs)
    name = free_name(docs_, "row_key")
    return docs_.select(*(F.col(f"`{c}`") for c in docs.columns), key.alias(name)), name


def _decided(docs: DataFrame, key: str, decisions: DataFrame) -> DataFrame:
    """docs' rows, each as often as decisions (rid, copies) say; all columns but the key stay as they are."""
    told, copies = free_name(docs, "decided_row"), free_name(docs, "decided_copies")
    kept = decisions.filter("copies > 0").select(F.col("rid").alias(told), F.col("copies").alias(copies))
    rows = docs.join(kept.hint("merge"), F.col(key) == F.col(told)).drop(key, told)  # what is kept grows with the input
    return rows.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    return _decided(keyed, key, exact_duplicates(keyed, row_col=key).filter("kept").select("rid", F.lit(1).alias("copies")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    return _decided(keyed, key, near_duplicates(keyed, row_col=key).filter("kept").select("rid", F.lit(1).alias("copies")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes twice are in the result twice."""
    keyed, key = _keyed(docs)
    return _decided(keyed, key, mix(keyed, row_col=key).select("rid", "copies"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", tokens_stage),
]

#: Learned rules, sampling and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if k < len(STAGES) - 1:
            rows = materialize(rows, f"stage-{k}")
    return rows
