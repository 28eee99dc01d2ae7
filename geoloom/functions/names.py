"""Names of scenes, folders, metrics and classes as Column expressions."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: extensions of raster files.
RASTER_PATTERN = r"(?i)\.(tif|tiff)$"


#: Metrics that a run's report leaves out start with one of these words and one of these separators,
EXCLUDED_METRIC_WORDS = ("val", "train", "diagnostics", "system", "recource", "resource", "resourse", "resources")
EXCLUDED_METRIC_SEPARATORS = ("/", ".", "_")
#: have one of these anywhere,
EXCLUDED_METRIC_PARTS = ("threshold_sweep", "best_threshold", "microtiming", "debug")
#: or are, or end in, one of these after an underscore (slashes and dots count as one).
PIXEL_COUNTERS = ("pixel_tp", "pixel_fp", "pixel_fn", "pixel_tn", "tp_pixels", "fp_pixels", "fn_pixels", "tn_pixels")
#: Names of the pixel F1, the most preferred first, and the pattern of names that end in a threshold.
PIXEL_F1_NAMES = (
    "f1_pixel", "model_metrics/f1_pixel", "best_val_pixel_f1", "val_pixel_f1", "pixel_f1", "best_pixel_f1",
    "val_dice", "dice", "f1", "pixel_dice", "metrics.pixel_f1",
)
THRESHOLD_PATTERN = r"(?i)(?:^|[./_])(?:best_)?(?:val_)?(?:pixel_)?(?:f1|dice)(?:[./_@:-]*(?:threshold|thr|t))?[./_@:-]*([01](?:\.\d+)?)$"
#: What run ids consist of, and the length that slugs are cut to.
RUN_ID_PATTERN, RUN_ID_LENGTH = r"^[A-Za-z0-9._-]+$", 180
#: Keys of secrets, what stands for their values, and the length from which values are looked for in texts.
SECRET_KEY_PATTERN = r"(?i)(password|secret|token|access_key)"
MASK, LEAST_MASKED = "***", 4
#: Properties that may name a feature's scene, the first comes first, and a raster's file name in a text.
SCENE_PROPERTIES = (
    "scene", "scene_id", "scene_name", "image", "image_name", "image_id", "filename", "file", "tif", "tiff", "raster", "source", "source_file", "src",
)
RASTER_IN_TEXT = r"(?i)([^\\/\s;,\"]+\.(?:tif|tiff))"
#: Names of each class, and its slug.
CLASSES = (
    (("Озера", "lakes", "lake"), "lakes"),
    (("Абразия", "abrasion"), "abrasion"),
    (("Обвально-оползневые и осыпные", "obval_opolz_osyp", "landslide", "оползневые", "осыпные"), "obval_opolz_osyp"),
    (("Водная эрозия", "water_erosion"), "water_erosion"),
    (("Ветровая эрозия", "wind_erosion"), "wind_erosion"),
    (("Вырубки", "deforest", "deforestation", "cuttings"), "deforest"),
    (("Гари", "burnt_forests", "burned", "fire"), "burnt_forests"),
    (("Границы леса", "forest_boundaries", "forest"), "forest_boundaries"),
    (("Засоления", "salty", "salinization"), "salty"),
    (("Карьеры", "quarries", "careers"), "quarries"),
    (("Опустынивание", "desertification"), "desertification"),
    (("Пашни", "arable_land", "areas_of_used_arable_land", "pashni"), "arable_land"),
)
#: Forms of messages.
WARNING_FORMS = {
    "not_selected": r"^(\d+) TIFF/TIF images are available but not selected by scenes_file",
    "geometry_fallback": r"^geometry fallback used with annotation CRS (.+)$",
    "zero_objects": r"^(\d+) scenes have zero objects",
}
UNMATCHED_FORM, CONFIG_FILE = r"^(\d+) scenes from scenes_file were not matched", "pipeline.server.yaml"


def base_name(path: Column) -> Column:
    """The last part of a path that is not empty: a folder's name too."""
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def scene_stem(path: Column) -> Column:
    """Base name without a raster extension."""
    return F.regexp_replace(base_name(F.trim(path)), RASTER_PATTERN, "")


def norm_scene_name(value: Column) -> Column:
    """(The patterns are fixed values.) Base name in lower case without side-car and raster extensions, a `cog` ending, and all but letters and digits of ASCII."""
    name = F.lower(base_name(F.trim(value)))
    name = F.regexp_replace(name, r"\.aux\.xml$", "")
    name = F.regexp_replace(name, r"\.(tif|tiff)$", "")
    name = F.regexp_replace(name, r"[_\-. ]?cog$", "")
    return F.regexp_replace(name, "[^a-z0-9]+", "")


def scene_signature(normalized: Column) -> Column:
    """Date, time and scene number of a satellite product's normalized name; null for other names."""
    pattern = r"kanopus(\d{8})(\d{6}).*?scn(\d{1,2})"
    part = lambda k: F.regexp_extract(normalized, pattern, k)
    made = F.concat(F.lit("kanopus:"), part(1), F.lit(":"), part(2), F.lit(":scn"), F.lpad(F.try_to_number(part(3), F.lit("99")).cast("int").cast("string"), 2, "0"))
    return F.when(part(1) != "", made)


def scene_entry(line: Column) -> Column:
    """First word of a scene list's line, with forward slashes; null for blanks and comments. A byte order mark is dropped."""
    clean = F.trim(F.regexp_replace(line, "^﻿+", ""))
    return F.when((clean != "") & ~clean.startswith("#"), F.translate(F.element_at(F.split(clean, r"\s+"), 1), "\\", "/"))


def folder_path(path: Column) -> Column:
    """A folder without slashes at its ends, in lower case."""
    return F.lower(F.trim(F.translate(path, "\\", "/"), F.lit("/")))


def ancestors(path: Column) -> Column:
    """All folders above a path, from the topmost."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).otherwise(F.array().cast("array<string>"))


def metric_key(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def validation_kind(split: Column) -> Column:
    text = F.lower(F.coalesce(split, F.lit("")))
    return (
        F.when(text.rlike("scene_level|leave_one_scene|scene_group"), F.lit("scene_level"))
        .when(text.contains("spatial") | text.contains("block"), F.lit("spatial_holdout"))
        .when(text.contains("tile"), F.lit("tile_holdout"))
        .otherwise(F.lit("unknown"))
    )


def excluded_metric(name: Column) -> Column:
    """Whether a report leaves a metric out."""
    low = F.lower(name)
    heads = [low.startswith(w + s) for w in EXCLUDED_METRIC_WORDS for s in EXCLUDED_METRIC_SEPARATORS]
    parts = [low.contains(x) for x in EXCLUDED_METRIC_PARTS]
    ends = [F.concat(F.lit("_"), F.translate(low, "/.", "__")).endswith("_" + x) for x in PIXEL_COUNTERS]
    out = F.lit(False)
    for test in (*heads, *parts, *ends):
        out = out | test
    return out


def metric_threshold(name: Column) -> Column:
    """The threshold at the end of an F1's or Dice's name, null for other names."""
    found = F.regexp_extract(name, THRESHOLD_PATTERN, 1)
    return F.when(found != "", found.cast("double"))


def pixel_f1_place(name: Column) -> Column:
    """A name's place among PIXEL_F1_NAMES, however it is punctuated; null for other names."""
    key = metric_key(name)
    return F.coalesce(*(F.when(key == re.sub("[^a-z0-9]+", "_", x), F.lit(k)) for k, x in enumerate(PIXEL_F1_NAMES)))


def first_non_empty(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


@F.pandas_udf(T.StringType())
def mask_secrets(text: pd.Series) -> pd.Series:
    """JSON of any depth with the values behind secret keys replaced by MASK, whatever they are; null for nulls and text that is no JSON."""

    def masked(value: object) -> object:
        if isinstance(value, dict):
            return {k: MASK if re.search(SECRET_KEY_PATTERN, k) else masked(v) for k, v in value.items()}
        return [masked(v) for v in value] if isinstance(value, list) else value

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(masked(json.loads(x)), ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return None

    return text.map(one)


def mask_text(text: Column, known: dict[str, str]) -> Column:
    """Text without the values of known settings whose names are secret, if they have LEAST_MASKED characters or more."""
    for key, value in known.items():
        if len(value) >= LEAST_MASKED and re.search(SECRET_KEY_PATTERN, key):
            text = F.replace(text, F.lit(value), F.lit(MASK))
    return text


def scene_of_properties(properties: Column) -> Column:
    """The scene that a feature's properties (a map) name: of the first of SCENE_PROPERTIES that is not blank a raster's file name in it, else its last path part."""

    def one(field: str) -> Column:
        value = F.trim(properties[field])
        inside = F.regexp_extract(value, RASTER_IN_TEXT, 1)
        plain = lambda c: base_name(F.translate(F.trim(F.trim(F.trim(c), F.lit('"')), F.lit("'")), "\\", "/"))
        return F.nullif(plain(F.when(inside != "", inside).otherwise(value)), F.lit(""))

    return F.coalesce(*(one(field) for field in SCENE_PROPERTIES))


def class_slug(text: Column) -> Column:
    """The first class one of whose names is the text, in it, or has it in itself (unless both have under 4 characters); null if there is none."""
    plain = lambda x: x.lower().replace("-", "_").replace(" ", "_")
    told = F.translate(F.lower(text), "- ", "__")

    def fits(name: str) -> Column:
        within = told.contains(name) | F.lit(name).contains(told)
        return (told == name) | (within if len(name) >= 4 else within & (F.char_length(told) >= 4))

    rungs = []
    for names, slug in CLASSES:
        found = F.lit(False)
        for name in names:
            found = found | fits(plain(name))
        rungs.append(F.when((told != "") & found, F.lit(slug)))
    return F.coalesce(*rungs)


def warning_class(message: Column) -> Column:
    """(kind, code, value) of a report's warning: three known forms are information, with their number or reference system, all others are warnings."""
    value = lambda p: F.regexp_extract(message, p, 1)
    number = F.regexp_extract(value(WARNING_FORMS["geometry_fallback"]), r"EPSG::?(\d+)", 1)
    crs = F.when(number != "", F.concat(F.lit("EPSG:"), number)).otherwise(value(WARNING_FORMS["geometry_fallback"]))
    told = lambda kind, code, v: F.struct(F.lit(kind).alias("kind"), F.lit(code).alias("code"), v.cast("string").alias("value"))
    made = F.when(F.lit(False), told("", "", F.lit(None)))
    for code, pattern in WARNING_FORMS.items():
        made = made.when(value(pattern) != "", told("info", code, crs if code == "geometry_fallback" else value(pattern)))
    return made.otherwise(told("warning", "other", message))


def error_class(message: Column) -> Column:
    """(code, value) of a failure's message; null for nulls and empty messages."""
    told = lambda code, v: F.struct(F.lit(code).alias("code"), v.cast("string").alias("value"))
    lost = F.regexp_extract(message, UNMATCHED_FORM, 1)
    return (
        F.when(message.contains(CONFIG_FILE) & (message.contains("No such file") | message.contains("not found")), told("config_missing", F.lit(None)))
        .when(message.contains("No scenes were matched"), told("no_scenes", F.lit(None)))
        .when(lost != "", told("scenes_unmatched", lost))
        .when(message != "", told("technical", message))
    )


def run_slug(text: Column) -> Column:
    """A safe run id made of a text."""
    slug = F.substring(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "_"), 1, RUN_ID_LENGTH)
    return F.when(slug != "", slug).otherwise(F.lit("run"))


def is_run_id(text: Column) -> Column:
    return text.rlike(RUN_ID_PATTERN)


def name_number(name: Column) -> Column:
    """The number at a name's end, null if there is none."""
    digits = F.regexp_extract(name, r"(\d+)$", 1)
    return F.when(digits != "", digits.cast("bigint"))


def canonical_json(fields: dict[str, Column], of: DataFrame) -> Column:
    """JSON of some columns of a frame with sorted keys, a space after commas and colons, and nulls written: texts, whole numbers, and arrays of texts."""
    told = of.select(*(c.alias(k) for k, c in fields.items())).schema
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), "\n", "\\\\n"), "\t", "\\\\t"), F.lit('"'))

    def value(k: str) -> Column:
        kind = told[k].dataType.simpleString()
        if kind == "string":
            return quoted(fields[k])
        if kind == "array<string>":
            return F.concat(F.lit("["), F.array_join(F.transform(fields[k], quoted), ", "), F.lit("]"))
        return fields[k].cast("string")

    parts = [F.concat(F.lit(f'"{k}": '), F.coalesce(value(k), F.lit("null"))) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
