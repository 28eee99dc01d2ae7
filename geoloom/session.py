"""Session defaults that suit the engine: adaptive execution, UTC, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, app: str = "geoloom", **conf: str) -> SparkSession:
    """A session with DEFAULTS, unless conf says otherwise (underscores stand for dots)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
