"""Tables that survive the loss of executors, in the folder that all of them share, and how many tasks deal rows out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in spark.checkpoint.dir. Only a local session, all on one machine, may leave that unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(named or f'file://{tempfile.gettempdir()}/checkpoints').rstrip('/')}/{label}-{uuid.uuid4().hex}"


def shuffle_tasks(spark: SparkSession) -> int:
    """How many tasks a shuffle has. Named in repartition(), they stay as many for rows of few bytes that cost time or grow."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Held:
    """Tables written for a while: put() writes one and reads it back, drop() deletes all but those that are still needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.paths: list[str] = []

    def put(self, df: DataFrame) -> DataFrame:
        path = shared_path(self.spark, self.label)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        """Deletes all tables but the last ones."""
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(there, True)
        self.paths = self.paths[len(gone) :]
