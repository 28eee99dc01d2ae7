"""Sinks: JSON, tab-separated reports, GeoJSON, checksums, Prometheus text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, form: str = "json") -> None:
    """Writes one of json, jsonl.gz, tsv, csv; overwriting is atomic per Spark's commit protocol."""
    w = df.write.mode("overwrite")
    if form == "json":
        w.json(path)
    elif form == "jsonl.gz":
        w.option("compression", "gzip").json(path)
    elif form == "tsv":
        w.option("sep", "\t").option("header", True).csv(path)
    elif form == "csv":
        w.option("header", True).csv(path)
    else:
        raise ValueError(form)


def geojson_feature(b: tuple[Column, Column, Column, Column], properties: list[str]) -> Column:
    """A box as a GeoJSON feature's text."""
    x0, y0, x1, y1 = (c.cast("double") for c in b)
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")))


def feature_collection(name: Column, features: Column, epsg: int) -> Column:
    """The text of a collection with a name and a reference system, of an array of features' texts."""
    named = F.to_json(F.struct(name.alias("name")))
    head = F.concat(F.lit('{"type":"FeatureCollection",'), F.substring(named, F.lit(2), F.char_length(named) - 2), F.lit(f',"crs":{{"type":"name","properties":{{"name":"urn:ogc:def:crs:EPSG::{epsg}"}}}},"features":['))
    return F.concat(head, F.array_join(features, ","), F.lit("]}"))


def write_geojson_gz(texts: DataFrame, path: str) -> None:
    """Gzipped text, one collection (text) to a line."""
    texts.select("text").write.mode("overwrite").option("compression", "gzip").text(path)


#: A history has no more columns than this; with more, write_history stops.
MOST_METRICS = 10_000


def write_history(rows: DataFrame, metrics: str, path: str) -> list[str]:
    """Writes rows of a map of metrics as CSV and returns its columns: the sorted union of the maps' keys. What a row lacks is empty."""
    names = sorted(r[0] for r in rows.select(F.explode(F.map_keys(metrics))).distinct().limit(MOST_METRICS + 1).collect())
    if len(names) > MOST_METRICS:
        raise ValueError(f"more than {MOST_METRICS} metrics")
    rows.select(*(F.col(metrics)[k].alias(k) for k in names)).write.mode("overwrite").option("header", True).csv(path)
    return names


def with_checksum(df: DataFrame, content: str) -> DataFrame:
    return df.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))


def not_committed(work: DataFrame, committed: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose keys and checksum are not in the committed table: what is left to do."""
    return work.join(committed.select(*keys, "sha256"), [*keys, "sha256"], "left_anti")


def prometheus_line(name: str, labels: list[str], value: Column) -> Column:
    """name{label="value",..} value"""
    quoted = [F.concat(F.lit(f'{k}="'), F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')) for k in labels]
    return F.concat(F.lit(name + "{"), F.concat_ws(",", *quoted), F.lit("} "), value.cast("string"))


def kept_tail(lines: DataFrame, key: list[str], order: str, size: Column, most: int) -> DataFrame:
    """Lines of logs (key, order) with log_bytes, compacted (the log has more than `most` bytes) and kept.

    Of a log that is too long its last `most` bytes stay (1024 at least), less the line that they begin in; of the others all. A line has
    size bytes and its end. With most of 0 or less nothing stays.
    """
    w = Window.partitionBy(*key)
    bytes_ = (size + 1).cast("bigint")
    told = lines.withColumns({"log_bytes": F.sum(bytes_).over(w), "tail_bytes": F.sum(bytes_).over(w.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0))})
    long = F.col("log_bytes") > most
    kept = F.lit(False) if most <= 0 else ~long | (F.col("tail_bytes") < max(1024, most))
    return told.withColumns({"compacted": long, "kept": kept}).drop("tail_bytes")
