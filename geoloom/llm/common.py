"""Shared plumbing of the training-data operators: durable intermediate tables and size estimates."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder (tests, a laptop).
DEFAULT_SHARED_DIR = "/tmp/checkpoints"

#: Fixed value: a word is a maximal run of characters outside these six (space, \t, \n, \v, \f, \r).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir. Only a local session, all on one machine, may leave it unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (named or DEFAULT_SHARED_DIR).rstrip("/")


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back. codec: what Parquet compresses with, if not the session's.

    Cuts the lineage with a copy that survives the loss of any executor and keeps
    generated ids from being drawn twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def row_key(docs: DataFrame) -> tuple[DataFrame, Column]:
    """(docs, a column that tells its rows apart, also rows that are equal in every column), the same in every job.

    Rows that are read straight from Parquet files are told apart by their file and their place in it. Any other
    rows are numbered and written first, as numbers drawn anew might differ.
    """
    with contextlib.suppress(AnalysisException, AttributeError):
        if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
            place = docs.metadataColumn("_metadata")
            key = F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("at"))
            docs.select(key)  # fails where the files have no places
            return docs, key
    name = free_name(docs, "row")
    drawn = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at"))
    return materialize(docs.withColumn(name, drawn), "rows"), F.col(name)


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores as no column of df has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: What operators keep in a Python worker between batches, by operator.
_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What one operator keeps in this Python worker. What others kept goes, as workers live on for other work."""
    if owner not in _KEPT:
        _KEPT.clear()
        release_memory()
        _KEPT[owner] = {}
    return _KEPT[owner]


def release_memory() -> None:
    """Gives memory that is free back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def tidy(owner: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches that leaves no memory of its own in the worker but worker_cache(owner)."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache(owner)
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of df's size in bytes (file sizes for scans); no job is run."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, ValueError):
        return 0


def buckets_for(df: DataFrame, bytes_each: int, least: int, most: int = 1 << 20) -> int:
    """A power of two of hash buckets so that a bucket holds about bytes_each of df."""
    size, n = min(plan_bytes(df), 1 << 60), least
    while n < most and n * bytes_each < size:
        n *= 2
    return n


def bucket_of(n: int, *cols: Column | str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n).cast("long"))


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
