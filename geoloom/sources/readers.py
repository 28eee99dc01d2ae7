"""Readers of listings, scene lists, GeoJSON, manifests and probability artifacts."""

from __future__ import annotations

import io
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import scene_entry


def list_objects(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(key, name, size, last_modified) of files under path, by Spark's own listing; contents are not read. In the order of lower-cased keys."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)
    rows = files.select(F.col("path").alias("key"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))
    return rows.orderBy(F.lower("key"))


def extension(key: Column) -> Column:
    return F.lower(F.regexp_extract(key, r"(\.[^./]+)$", 1))


def layout_status(listing: DataFrame, prefixes: list[str]) -> DataFrame:
    """One row: number of files and bytes, and whether anything lies under each prefix."""
    return listing.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *((F.count_if(F.col("key").contains(p)) > 0).alias(f"has_{p.strip('/').replace('/', '_')}") for p in prefixes))


def prefix_status(listing: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """(prefix, exists, object_count, total_size_bytes) for each prefix, of a listing (key, size), in one pass over it."""
    under = F.filter(F.array(*(F.lit(p) for p in prefixes)), lambda p: F.startswith("key", p))
    found = listing.select("size", F.explode(under).alias("prefix")).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    all_ = listing.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    zero = F.lit(0).cast("bigint")
    return all_.join(found, "prefix", "left").select("prefix", F.col("n").isNotNull().alias("exists"), F.coalesce("n", zero).alias("object_count"), F.coalesce("bytes", zero).alias("total_size_bytes"))


def layout_files(listing: DataFrame, by: list[str], scenes_file: str = "scenes.txt") -> DataFrame:
    """(by, annotation, scenes): of each layout's keys the last that ends in .geojson, and the last whose name is the scene list's; case does not matter."""
    last = lambda on: F.max(F.when(on, F.col("key")))
    name = F.lower(F.element_at(F.split("key", "/"), -1))
    return listing.groupBy(*by).agg(last(name.endswith(".geojson")).alias("annotation"), last(name == scenes_file.lower()).alias("scenes"))


def image_warnings(listing: DataFrame) -> DataFrame:
    """(warning) for each file name and each stem that several keys of a listing share, case aside, with the keys in order of their lower case."""
    name = F.lower(F.element_at(F.split("key", "/"), -1))
    kinds = F.array(F.struct(F.lit("filename").alias("kind"), name.alias("name")), F.struct(F.lit("stem").alias("kind"), F.regexp_replace(name, r"(.)\.[^.]*$", "$1").alias("name")))
    rows = listing.select("key", F.explode(kinds).alias("k")).groupBy("k.kind", "k.name").agg(F.sort_array(F.collect_list(F.struct(F.lower("key").alias("low"), "key"))).alias("keys"))
    told = F.concat(F.lit("duplicate_"), "kind", F.lit(": "), "name", F.lit(": "), F.array_join(F.transform("keys", lambda k: k["key"]), "; "))
    return rows.filter(F.size("keys") > 1).select(told.alias("warning"))


def read_scene_list(spark: SparkSession, path: str) -> DataFrame:
    """(entry) of a scene list: first word of each line that is neither blank nor a comment; line ends and byte order marks are handled."""
    return spark.read.text(path).select(scene_entry(F.translate("value", "\r", "")).alias("entry")).filter("entry is not null")


_FEATURE = "struct<type:string,properties:map<string,string>,geometry:string>"


def geojson_features(texts: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, idx, properties, geometry, warning) of GeoJSON texts: collections, single features or bare geometries; text that is no JSON gives one row with a warning."""
    text = F.regexp_replace(F.col(json_col), "^﻿", "")
    kind = F.get_json_object(text, "$.type")
    many = F.from_json(F.get_json_object(text, "$.features"), f"array<{_FEATURE}>")
    one = F.from_json(text, _FEATURE)
    bare = F.struct(F.lit("Feature").alias("type"), F.lit(None).cast("map<string,string>").alias("properties"), text.alias("geometry"))
    items = F.when(kind == "FeatureCollection", many).when(kind == "Feature", F.array(one)).when(kind.isNotNull(), F.array(bare)).otherwise(F.array(F.lit(None).cast(_FEATURE)))
    rows = texts.select(F.col(id_col).alias("id"), F.posexplode_outer(items).alias("idx", "f"))
    warning = F.when(F.col("f").isNull(), "no feature").when(F.col("f.geometry").isNull(), "feature without geometry")
    return rows.select("id", "idx", "f.properties", "f.geometry", warning.alias("warning"))


def manifest_scenes(manifests: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, idx, scene, uri) of inference manifests: `scenes`, else `scene_results`; the uri as given, else from bucket and key."""
    item = "struct<scene_id:string,uri:string,s3_uri:string,bucket:string,key:string>"
    found = F.coalesce(F.from_json(F.get_json_object(json_col, "$.scenes"), f"array<{item}>"), F.from_json(F.get_json_object(json_col, "$.scene_results"), f"array<{item}>"))
    rows = manifests.select(F.col(id_col).alias("id"), F.posexplode(found).alias("idx", "s"))
    uri = F.coalesce("s.uri", "s.s3_uri", F.concat(F.lit("s3://"), "s.bucket", F.lit("/"), "s.key"))
    return rows.select("id", "idx", F.col("s.scene_id").alias("scene"), uri.alias("uri"))


def probability_artifacts(spark: SparkSession, path: str, glob: str = "*.np[yz]", band: str | None = None) -> DataFrame:
    """probability_pixels() of array files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return probability_pixels(files.select(F.col("path").alias("key"), "content"), band)


def probability_pixels(arrays: DataFrame, band: str | None = None) -> DataFrame:
    """(key, y, x, prob) of arrays (key, content) in npy or npz form; of archives `band`, else prob_uint8, else prob, else the first. Bytes are read back as n / 255."""
    wanted = [b for b in (band, "prob_uint8", "prob") if b]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        @lru_cache(maxsize=1024)
        def layout(head: bytes) -> tuple[np.dtype, tuple[int, ...], bool]:
            f = io.BytesIO(head)
            version = np.lib.format.read_magic(f)
            shape, fortran, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
            return dtype, shape, fortran

        def array(content: bytes) -> tuple[str | None, np.ndarray]:
            # small arrays come in great numbers, with few different headers
            if content[:6] == b"\x93NUMPY" and content[6] in (1, 2):
                end = 10 + int.from_bytes(content[8:10], "little") if content[6] == 1 else 12 + int.from_bytes(content[8:12], "little")
                dtype, shape, fortran = layout(bytes(content[:end]))
                if not dtype.hasobject:
                    n = math.prod(shape)
                    return None, np.frombuffer(content, dtype, n, end).reshape(shape, order="F" if fortran else "C")
            a = np.load(io.BytesIO(content), allow_pickle=False)
            if not hasattr(a, "files"):
                return None, a
            name = next((k for k in wanted if k in a.files), a.files[0])
            return name, a[name]

        places = lru_cache(maxsize=64)(lambda shape: [x.ravel().astype("int64") for x in np.indices(shape)])

        def told(held: list[tuple[str, np.ndarray]]) -> pd.DataFrame:
            at = [places(p.shape) if p.size <= 1 << 16 else [x.ravel().astype("int64") for x in np.indices(p.shape)] for _, p in held]
            keys = np.repeat(np.array([k for k, _ in held], dtype=object), [p.size for _, p in held])
            return pd.DataFrame({"key": keys, "y": np.concatenate([y for y, _ in at]), "x": np.concatenate([x for _, x in at]), "prob": np.concatenate([p.ravel() for _, p in held])})

        for frame in frames:
            held, size = [], 0
            for key, content in zip(frame["key"], frame["content"], strict=True):
                name, a = array(content)
                p = a.astype("float32") / 255 if name == "prob_uint8" or a.dtype == np.uint8 else a.astype("float32")
                held.append((key, p))
                size += p.size
                if size >= 1 << 20:
                    yield told(held)
                    held, size = [], 0
            if held:
                yield told(held)

    return arrays.select("key", "content").mapInPandas(run, "key string, y bigint, x bigint, prob float")
