"""Names, scene lists, matching, splits, object metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.geometry import epsg_code
from ..functions.metrics import object_scores
from ..operators import objects as ob
from ..operators import scene_match as sm
from ..operators import splits as sp
from ..operators.ranked_join import ranked_rule_join
from ..sources import readers as rd
from .registry import query
from .views import Tables


def norm(x: str) -> str:
    base = f"lower(list_last(string_split(rtrim(trim({x}), '/'), '/')))"
    for pattern in (r"\.aux\.xml$", r"\.(tif|tiff)$", r"[_\-. ]?cog$"):
        base = f"regexp_replace({base}, '{pattern}', '')"
    return f"regexp_replace({base}, '[^a-z0-9]+', '', 'g')"


def signature(x: str) -> str:
    part = lambda k: f"regexp_extract({x}, 'kanopus(\\d{{8}})(\\d{{6}}).*?scn(\\d{{1,2}})', {k})"
    return f"CASE WHEN {part(1)} <> '' THEN 'kanopus:' || {part(1)} || ':' || {part(2)} || ':scn' || lpad(CAST(CAST({part(3)} AS INT) AS VARCHAR), 2, '0') END"


_ENTRY = "CASE WHEN trim(raw) <> '' AND trim(raw) NOT LIKE '#%' THEN replace(regexp_extract(trim(raw), '^\\S+'), chr(92), '/') END"
_ENTRIES = f"entries AS (SELECT seq, {_ENTRY} AS entry FROM @scene_lines WHERE {_ENTRY} IS NOT NULL)"


def entries(t: Tables) -> DataFrame:
    return t.scene_lines.select("seq", N.scene_entry(F.col("raw")).alias("entry")).filter("entry is not null")


@query("src4_scene_list", f"WITH {_ENTRIES} SELECT * FROM entries")
def scene_list(t: Tables) -> DataFrame:
    return entries(t)


@query("fn1_norm_scene_name", f"SELECT image, {norm('key')} AS name FROM @images")
def norm_scene_name(t: Tables) -> DataFrame:
    return t.images.select("image", N.norm_scene_name(F.col("key")).alias("name"))


@query("fn2_scene_signature", f"SELECT image, {signature(norm('key'))} AS sig FROM @images")
def scene_signature(t: Tables) -> DataFrame:
    return t.images.select("image", N.scene_signature(N.norm_scene_name(F.col("key"))).alias("sig"))


@query("fn5_folder_paths", f"WITH {_ENTRIES} SELECT seq, lower(trim(replace(entry, chr(92), '/'), '/')) AS folder FROM entries")
def folder_paths(t: Tables) -> DataFrame:
    return entries(t).select("seq", N.folder_path(F.col("entry")).alias("folder"))


@query("gen5_folder_prefixes", "SELECT folder, count(*) AS images FROM (SELECT array_to_string(p[1:k], '/') AS folder FROM (SELECT string_split(key, '/') AS p FROM @images) q, unnest(range(1, len(p))) AS u(k)) f GROUP BY 1")
def folder_prefixes(t: Tables) -> DataFrame:
    return t.images.select(F.explode(N.ancestors(F.col("key"))).alias("folder")).groupBy("folder").agg(F.count(F.lit(1)).alias("images"))


@query("fn7_metric_key", "SELECT DISTINCT p_name, trim(regexp_replace(lower('Val/' || p_name || ' @0.5'), '[^a-z0-9]+', '_', 'g'), '_') AS key FROM @part")
def metric_key(t: Tables) -> DataFrame:
    return t.part.select("p_name", N.metric_key(F.concat(F.lit("Val/"), "p_name", F.lit(" @0.5"))).alias("key")).distinct()


_SPLITS = ("Scene_Level", "leave_one_scene_out", "by scene_group", "spatial", "block_holdout", "random", "scenes by tile", "TILES", "")
_SPLIT_TEXT = "CASE run_id % 10 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_SPLITS)) + " END"


@query(
    "fn11_validation_kind",
    f"""SELECT run_id, split, CASE WHEN split ILIKE '%scene\\_level%' ESCAPE '\\' OR split ILIKE '%leave\\_one\\_scene%' ESCAPE '\\' OR split ILIKE '%scene\\_group%' ESCAPE '\\' THEN 'scene_level'
    WHEN split ILIKE '%spatial%' OR split ILIKE '%block%' THEN 'spatial_holdout' WHEN split ILIKE '%tile%' THEN 'tile_holdout' ELSE 'unknown' END AS kind
    FROM (SELECT run_id, {_SPLIT_TEXT} AS split FROM @runs) r""",
)
def validation_kind(t: Tables) -> DataFrame:
    return t.runs.select("run_id", F.expr(_SPLIT_TEXT).alias("split")).withColumn("kind", N.validation_kind(F.col("split")))


@query("fn8_first_non_empty", "SELECT run_id, coalesce(nullif(trim(run_status), ''), CASE WHEN run_id % 3 = 0 THEN NULL ELSE 'unknown' END, 'none') AS status FROM @runs")
def first_non_empty(t: Tables) -> DataFrame:
    return t.runs.select("run_id", N.first_non_empty(F.col("run_status"), F.when(F.col("run_id") % 3 != 0, F.lit("unknown")), F.lit("none")).alias("status"))


_KNOWN = {"API_TOKEN": "tok-12345", "SHORT_TOKEN": "abc", "REGION": "north"}


@query(
    "fn16_masked_secrets",
    """SELECT event_id, '{"id":' || CAST(event_id AS VARCHAR) || ',"db":{"DB_Password":"***","host":"' || stage || '"},"items":[{"api_token":"***","n":' || CAST(tile AS VARCHAR) || '}],"aws_secret_access_key":"***"}' AS settings,
    stage || ' used *** in north with abc' AS note FROM @messages""",
)
def masked_secrets(t: Tables) -> DataFrame:
    """Settings of any depth by their keys, and free text by known values."""
    db = F.struct(F.col("value").alias("DB_Password"), F.col("stage").alias("host"))
    items = F.array(F.struct(F.col("stage").alias("api_token"), F.col("tile").alias("n")))
    settings = F.to_json(F.struct(F.col("event_id").alias("id"), db.alias("db"), items.alias("items"), F.array(F.col("bytes")).alias("aws_secret_access_key")))
    note = F.concat("stage", F.lit(" used tok-12345 in north with abc"))
    return t.messages.select("event_id", N.mask_secrets(settings).alias("settings"), N.mask_text(note, _KNOWN).alias("note"))


_RUN_TEXT = "CASE p_partkey % 4 WHEN 0 THEN p_name || ' (new) #1' WHEN 1 THEN replace(p_name, ' ', '.') WHEN 2 THEN repeat(p_name || '-', 9) ELSE '' END"


@query(
    "fn15_run_slug",
    f"""SELECT p_partkey, coalesce(nullif(left(regexp_replace(x, '[^A-Za-z0-9._-]+', '_', 'g'), 180), ''), 'run') AS slug,
    x <> '' AND NOT regexp_matches(x, '[^A-Za-z0-9._-]') AS valid FROM (SELECT p_partkey, {_RUN_TEXT} AS x FROM @part) p""",
)
def run_slug(t: Tables) -> DataFrame:
    text = F.expr(_RUN_TEXT)
    return t.part.select("p_partkey", N.run_slug(text).alias("slug"), N.is_run_id(text).alias("valid"))


@query("fn35_next_run_number", "SELECT s_nationkey, max(CAST(regexp_extract(s_name, '(\\d+)$', 1) AS BIGINT)) + 1 AS next FROM @supplier GROUP BY 1")
def next_run_number(t: Tables) -> DataFrame:
    return t.supplier.groupBy("s_nationkey").agg((F.max(N.name_number(F.col("s_name"))) + 1).alias("next"))


_METRICS = ("Val/loss", "val.f1", "value", "train_loss", "training_time_sec", "System/gpu", "recource.ram", "resourse_cpu", "resources/disk", "f1_pixel", "epochs_total",
            "eval/threshold_sweep_3", "best_threshold", "a.microtiming.b", "DEBUG_x", "eval/pixel.tp", "fp_pixels", "xtn_pixels", "my.tn_pixels", "diagnostics.x", "resource")
_METRIC = f"CASE p_partkey % {len(_METRICS)} " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_METRICS)) + " END"


@query(
    "fn14_metric_filter",
    f"""SELECT p_partkey, name FROM (SELECT p_partkey, {_METRIC} AS name FROM @part) p
    WHERE NOT regexp_matches(lower(name), '^(val|train|diagnostics|system|recource|resource|resourse|resources)[/._]') AND NOT regexp_matches(lower(name), 'threshold_sweep|best_threshold|microtiming|debug')
    AND NOT regexp_matches(lower(name), '(^|[/._])(pixel[/._](tp|fp|fn|tn)|(tp|fp|fn|tn)[/._]pixels)$')""",
)
def metric_filter(t: Tables) -> DataFrame:
    """Metrics that a run's report shows."""
    return t.part.select("p_partkey", F.expr(_METRIC).alias("name")).filter(~N.excluded_metric(F.col("name")))


#: Properties of an image's feature, in another order than they are looked at.
_PROPERTIES = {
    "src": "CASE WHEN image % 7 < 5 THEN key END",
    "file": "CASE WHEN image % 3 = 0 THEN replace(key, '/', chr(92)) || chr(92) END",
    "image_name": "CASE WHEN image % 4 = 1 THEN 'see ' || key || '; more' END",
    "scene": "CASE image % 5 WHEN 0 THEN '  ' WHEN 1 THEN '\"' || key || '\"' END",
    "comment": "key",
}


def _named_scene(x: str) -> str:
    inside = f"regexp_extract(trim({x}), '([^\\\\/\\s;,\"]+\\.(?:tif|tiff))', 1, 'i')"
    whole = f"CASE WHEN {inside} <> '' THEN {inside} ELSE trim({x}) END"
    return f"nullif(list_last(string_split(rtrim(replace(trim(trim({whole}, '\"'), ''''), chr(92), '/'), '/'), '/')), '')"


@query("fn4_scene_of_properties", f"SELECT image, coalesce({', '.join(_named_scene(_PROPERTIES[k]) for k in ('scene', 'image_name', 'file', 'src'))}) AS scene FROM @images")
def scene_of_properties(t: Tables) -> DataFrame:
    """Which scene a feature names, among fourteen properties."""
    properties = F.create_map(*(x for k, v in _PROPERTIES.items() for x in (F.lit(k), F.expr(v))))
    return t.images.select("image", N.scene_of_properties(properties).alias("scene"))


@query("src6_crs_of_geojson", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'EPSG:' || CAST(32600 + c_custkey % 60 AS VARCHAR) WHEN 1 THEN 'EPSG:4326' END AS crs FROM @customer")
def crs_of_geojson(t: Tables) -> DataFrame:
    number = (F.col("c_custkey") % 60 + 32600).cast("string")
    named = lambda s: F.concat(F.lit('{"crs": {"properties": {"name": "'), s, F.lit('"}}}'))
    text = F.when(F.col("c_custkey") % 3 == 0, named(F.concat(F.lit("urn:ogc:def:crs:EPSG::"), number))).when(F.col("c_custkey") % 3 == 1, named(F.lit("EPSG:4326"))).otherwise(F.lit("{}"))
    return t.customer.select("c_custkey", epsg_code(F.get_json_object(text, "$.crs.properties.name")).alias("crs"))


_CLASS_TEXTS = ("Forest-Boundaries 2024", "lake", "Озера", "КАРЬЕРЫ юг", "fir", "la", "arable land", "", "Wind Erosion zone", "obval-opolz", "burned area", "salty", "гари", "road", "deforestation", "forest", "Пашни")
_CLASS_TEXT = f"CASE p_partkey % {len(_CLASS_TEXTS) + 2} " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_CLASS_TEXTS)) + f" WHEN {len(_CLASS_TEXTS)} THEN p_name END"
_CLASS_NAMES = ", ".join(f"({k}, '{name.lower().replace('-', '_').replace(' ', '_')}', '{slug}')" for k, (names, slug) in enumerate(N.CLASSES) for name in names)


@query(
    "fn6_class_slug",
    f"""WITH a AS (SELECT * FROM (VALUES {_CLASS_NAMES}) v(k, name, slug)), p AS (SELECT p_partkey, replace(replace(lower({_CLASS_TEXT}), '-', '_'), ' ', '_') AS x FROM @part)
    SELECT p_partkey, (SELECT arg_min(slug, k) FROM a WHERE x <> '' AND (name = x OR (NOT (len(name) < 4 AND len(x) < 4) AND (contains(x, name) OR contains(name, x))))) AS slug FROM p""",
)
def class_slug(t: Tables) -> DataFrame:
    """The class that a text names; few classes, so a conditional expression."""
    return t.part.select("p_partkey", N.class_slug(F.expr(_CLASS_TEXT)).alias("slug"))


def _last(x: str) -> str:
    return f"list_last(string_split(rtrim(trim({x}), '/'), '/'))"


def _stem(x: str) -> str:
    return f"regexp_replace({_last(x)}, '\\.(tif|tiff)$', '', 'i')"


_RUNGS = (
    ("filename_exact", lambda x: _last(x)),
    ("stem_exact", lambda x: _stem(x)),
    ("filename_casefold", lambda x: f"lower({_last(x)})"),
    ("stem_casefold", lambda x: f"lower({_stem(x)})"),
    ("normalized_scene", lambda x: f"nullif({norm(x)}, '')"),
)
_RULES = " UNION ALL ".join(f"SELECT e.seq, e.entry, i.image, {k} AS r FROM entries e JOIN @images i ON {f('e.entry')} = {f('i.key')}" for k, (_, f) in enumerate(_RUNGS))


@query(
    "jn1_ranked_match",
    f"""WITH {_ENTRIES}, m AS ({_RULES}),
    b AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY r, image) AS p, min(r) OVER (PARTITION BY seq) AS best FROM m)
    SELECT e.seq, e.entry, b.image, CASE b.r {" ".join(f"WHEN {k} THEN '{name}'" for k, (name, _) in enumerate(_RUNGS))} END AS rule,
    (SELECT count(*) FROM m WHERE m.seq = e.seq AND m.r = b.r) AS n_matches FROM entries e LEFT JOIN (SELECT * FROM b WHERE p = 1) b ON b.seq = e.seq""",
)
def ranked_match(t: Tables) -> DataFrame:
    """Entries to images by file name, then without extension, then both without case, then normalized; the first rule and the first image win."""
    forms = [lambda c: N.base_name(F.trim(c)), N.scene_stem]
    forms += [lambda c, f=f: F.lower(f(c)) for f in forms] + [lambda c: F.nullif(N.norm_scene_name(c), F.lit(""))]
    rules = [(name, f(F.col("entry")), f(F.col("key"))) for (name, _), f in zip(_RUNGS, forms, strict=True)]
    told = ranked_rule_join(entries(t), t.images, "seq", rules, [F.col("image")], ["image"])
    return told.select("seq", "entry", "image", "rule", F.when(F.col("rule").isNull(), F.lit(0)).otherwise(F.col("n_matches")).cast("bigint").alias("n_matches"))


@query(
    "jn3_folder_match",
    f"""WITH {_ENTRIES}, f AS (SELECT DISTINCT lower(array_to_string(p[1:k], '/')) AS folder FROM (SELECT string_split(key, '/') AS p FROM @images) q, unnest(range(1, len(p))) AS u(k)),
    w AS (SELECT seq, lower(trim(entry, '/')) AS wanted FROM entries)
    SELECT seq, count(DISTINCT folder) AS folders, min(folder) AS folder FROM w JOIN f ON folder = wanted OR suffix(folder, '/' || wanted) GROUP BY 1""",
)
def folder_match(t: Tables) -> DataFrame:
    return sm.folder_matches(entries(t), t.images)


@query("jn2_match_report")
def match_report(t: Tables) -> DataFrame:
    """No twin: the last rung is a Ratcliff-Obershelp likeness, which DuckDB does not have. Tests compare it with difflib over all pairs."""
    return sm.match_report(entries(t), t.images)


#: A listing in which three images share each name, in different folders.
_THREE_KEYS = "'root/x' || CAST(image % 5 AS STRING) || '/scene_' || CAST(CAST(floor(image / 3) AS BIGINT) AS STRING) || '.tif'"
_PREFIXES = ("root/x2/", "root/x4/", "root/")


@query(
    "jn2_preferred_images",
    f"""WITH n AS (SELECT image, {norm('key')} AS name, CASE {' '.join(f"WHEN starts_with(key, '{p}') THEN {k}" for k, p in enumerate(_PREFIXES))} END AS place FROM (SELECT image, {_THREE_KEYS} AS key FROM @images) q),
    f AS (SELECT name, place, count(*) AS n, min(image) AS image, min(place) OVER (PARTITION BY name) AS best FROM n GROUP BY name, place) SELECT name, image FROM f WHERE place = best AND n = 1""",
)
def preferred_images(t: Tables) -> DataFrame:
    """The image that preferred folders choose among those of one name."""
    images = t.images.select("image", F.expr(_THREE_KEYS).alias("key"))
    return sm.preferred(images.withColumn("name", N.norm_scene_name(N.base_name(F.col("key")))), "name", list(_PREFIXES))


@query(
    "jn2_folder_images",
    f"""WITH {_ENTRIES}, f AS (SELECT DISTINCT image, lower(array_to_string(p[1:k], '/')) AS folder FROM (SELECT image, string_split(key, '/') AS p FROM @images WHERE regexp_matches(lower(key), '[.]tiff?$')) q, unnest(range(1, len(p))) AS u(k)),
    w AS (SELECT seq, lower(trim(entry, '/')) AS wanted FROM entries), d AS (SELECT seq, min(folder) AS folder FROM w JOIN (SELECT DISTINCT folder FROM f) x ON folder = wanted OR suffix(folder, '/' || wanted) GROUP BY seq HAVING count(*) = 1)
    SELECT image, min(seq) AS seq FROM d JOIN f USING (folder) GROUP BY image""",
)
def folder_images(t: Tables) -> DataFrame:
    """Images that folders in the list stand for, each by the first entry that leads to it."""
    rasters = t.images.filter(sm.is_raster(F.col("key")))
    told = entries(t).join(sm.folder_matches(entries(t), rasters).filter("folders = 1"), "seq")
    report = told.select("seq", "entry", F.lit(None).cast("bigint").alias("image"), F.lit(None).cast("double").alias("score"), "folder", F.lit("folder_expanded").alias("decision"))
    return sm.matched_images(report, t.images).select("image", "seq")


@query("jn4_first_wins", f"WITH {_ENTRIES} SELECT name, min(seq) AS seq FROM (SELECT seq, {norm('entry')} AS name FROM entries) q GROUP BY 1")
def first_wins(t: Tables) -> DataFrame:
    return sm.first_wins(entries(t).select("seq", N.norm_scene_name(F.col("entry")).alias("name")), ["name"], ["seq"]).select("name", "seq")


@query("src7_image_index", f"SELECT {norm('key')} AS name, count(*) AS n, min(key) AS first_key FROM @images GROUP BY 1 HAVING count(*) > 1")
def image_index(t: Tables) -> DataFrame:
    """Names that several files share."""
    return t.images.groupBy(N.norm_scene_name(F.col("key")).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key")).filter("n > 1")


#: A listing in which files share names and stems.
_SHARED_KEYS = "CASE WHEN image % 6 = 1 THEN 'root/x' || CAST(image % 4 AS STRING) || '/Scene_' || CAST(image % 25 AS STRING) || CASE WHEN image % 4 < 2 THEN '.tif' ELSE '.TIFF' END ELSE key END"
_FILE = "lower(regexp_extract(key, '[^/]*$', 0))"


@query(
    "src7_image_warnings",
    f"""WITH i AS (SELECT {_SHARED_KEYS} AS key FROM @images), k AS (SELECT 'filename' AS kind, {_FILE} AS name, key FROM i UNION ALL SELECT 'stem', regexp_replace({_FILE}, '(.)[.][^.]*$', '\\1'), key FROM i)
    SELECT 'duplicate_' || kind || ': ' || name || ': ' || string_agg(key, '; ' ORDER BY lower(key), key) AS warning FROM k GROUP BY kind, name HAVING count(*) > 1""",
)
def image_warnings(t: Tables) -> DataFrame:
    """File names and stems that several images share."""
    return rd.image_warnings(t.images.select(F.expr(_SHARED_KEYS).alias("key")))


_COUNTS = "counts AS (SELECT s.scene, s.scene % 20 AS dataset, coalesce(c.n, 0) AS objects FROM @scenes s LEFT JOIN (SELECT scene, count(*) AS n FROM @annotations WHERE gid % 5 = 0 AND scene % 3 <> 0 GROUP BY 1) c ON c.scene = s.scene)"


def scene_object_counts(t: Tables) -> DataFrame:
    n = t.annotations.filter("gid % 5 = 0 and scene % 3 <> 0").groupBy("scene").agg(F.count(F.lit(1)).alias("n"))
    return t.scenes.join(n, "scene", "left").select("scene", (F.col("scene") % 20).alias("dataset"), F.coalesce("n", F.lit(0).cast("bigint")).alias("objects"))


@query("ag12_property_counts", f"WITH {_COUNTS} SELECT * FROM counts")
def property_counts(t: Tables) -> DataFrame:
    """Objects of each scene; scenes without any have 0."""
    return scene_object_counts(t)


@query("mt2_object_balanced_split")
def object_balanced_split(t: Tables) -> DataFrame:
    """No twin: an ordered fold with state. Tests compare it with a plain loop."""
    return sp.object_balanced_split(scene_object_counts(t)).select("dataset", "scene", "objects", "part")


@query("mt3_prefix_split", f"WITH {_COUNTS} SELECT dataset, scene, CASE WHEN row_number() OVER (PARTITION BY dataset ORDER BY scene) <= greatest(1, ceil(count(*) OVER (PARTITION BY dataset) * 0.7)) THEN 'train' ELSE 'val' END AS part FROM counts")
def prefix_split(t: Tables) -> DataFrame:
    return sp.prefix_split(scene_object_counts(t), ["scene"], 0.7, True, "dataset").select("dataset", "scene", "part")


_SPLIT = f"{_COUNTS}, split AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY dataset ORDER BY scene) <= greatest(1, floor(count(*) OVER (PARTITION BY dataset) * 0.8)) THEN 'train' ELSE 'val' END AS part FROM counts)"


@query(
    "ag11_split_summary",
    f"""WITH {_SPLIT} SELECT dataset, count(*) AS files, sum(objects) AS objects, count(*) FILTER (part = 'val') AS val_files, sum(CASE WHEN part = 'val' THEN objects ELSE 0 END) AS val_objects,
    round(CASE WHEN sum(objects) = 0 THEN 0 ELSE sum(CASE WHEN part = 'val' THEN objects ELSE 0 END) / sum(objects) END, 9) AS val_share, string_agg(DISTINCT part, ',' ORDER BY part) AS parts FROM split GROUP BY 1""",
)
def split_summary(t: Tables) -> DataFrame:
    rows = sp.prefix_split(scene_object_counts(t), ["scene"], 0.8, False, "dataset")
    val = F.sum(F.when(F.col("part") == "val", F.col("objects")).otherwise(0))
    share = F.when(F.sum("objects") == 0, 0.0).otherwise(val / F.sum("objects"))
    return rows.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("files"), F.sum("objects").alias("objects"), F.count_if(F.col("part") == "val").alias("val_files"), val.alias("val_objects"), F.round(share, 9).alias("val_share"),
        F.array_join(F.sort_array(F.collect_set("part")), ",").alias("parts"),
    )


@query("set3_split_disjoint", f"WITH {_SPLIT} SELECT count(*) AS shared FROM (SELECT dataset, scene FROM split WHERE part = 'train' INTERSECT SELECT dataset, scene FROM split WHERE part = 'val') q")
def split_disjoint(t: Tables) -> DataFrame:
    rows = sp.prefix_split(scene_object_counts(t), ["scene"], 0.8, False, "dataset").select("dataset", "scene", "part")
    side = lambda p: rows.filter(F.col("part") == p).drop("part")
    return side("train").intersect(side("val")).agg(F.count(F.lit(1)).alias("shared"))


@query("jn15_scene_rows", f"WITH {_SPLIT} SELECT i.image, s.part, s.objects FROM @images i LEFT JOIN split s ON s.scene = i.image AND s.scene % 2 = 0 UNION ALL SELECT -scene, part, objects FROM split WHERE scene % 2 = 1")
def scene_rows(t: Tables) -> DataFrame:
    """Listed scenes with counts and part, null where there are none; scenes that are not listed follow."""
    rows = sp.prefix_split(scene_object_counts(t), ["scene"], 0.8, False, "dataset").select("scene", "part", "objects")
    listed = t.images.select("image").join(rows.filter("scene % 2 = 0"), F.col("image") == F.col("scene"), "left").drop("scene")
    return listed.unionByName(rows.filter("scene % 2 = 1").select((-F.col("scene")).alias("image"), "part", "objects"))


@query("so3_scene_order", f"WITH {_COUNTS} SELECT scene, row_number() OVER (PARTITION BY dataset ORDER BY nullif(objects, 0) DESC NULLS LAST, scene) AS place FROM counts")
def scene_order(t: Tables) -> DataFrame:
    w = Window.partitionBy("dataset").orderBy(F.nullif("objects", F.lit(0)).desc_nulls_last(), "scene")
    return scene_object_counts(t).select("scene", F.row_number().over(w).alias("place"))


@query("jn21_lost_scenes", "SELECT image FROM @images WHERE image NOT IN (SELECT scene FROM @annotations WHERE gid % 3 = 0)")
def lost_scenes(t: Tables) -> DataFrame:
    return t.images.join(t.annotations.filter("gid % 3 = 0"), F.col("image") == F.col("scene"), "left_anti").select("image")


#: Settings of dataset d, as given and as configured.
_RAW = {"max_dataset_scenes": "CASE WHEN d % 7 = 1 THEN d + 1 END", "dataset_limit": "CASE WHEN d % 5 = 2 THEN 0 END", "max_scenes": "CASE WHEN d % 3 = 0 THEN 4 END", "dataset_limit_reason": "CASE WHEN d % 6 = 0 THEN 'pilot' END"}
_CONFIG = {"max_dataset_scenes": "CASE WHEN d % 11 = 1 THEN 3 END", "scene_limit": "CASE WHEN d % 4 = 3 THEN 6 END", "sample_size": "CASE WHEN d % 13 = 12 THEN 2 END", "limit_reason": "CASE WHEN d % 9 = 4 THEN 'budget' END"}
_LIMITS = f"""limits AS (SELECT dataset, CASE WHEN k IS NOT NULL THEN greatest(1, v) END AS value, 'pipeline_trace.preprocess.' || k AS source,
        CASE WHEN k IS NOT NULL THEN coalesce(why, CASE WHEN k = 'max_scenes' THEN 'preprocess.max_scenes compatibility limit' ELSE 'explicit dataset input limit configured' END) END AS reason
    FROM (SELECT d AS dataset, coalesce({_RAW['dataset_limit_reason']}, {_CONFIG['limit_reason']}) AS why,
        coalesce({_RAW['max_dataset_scenes']}, {_CONFIG['max_dataset_scenes']}, {_RAW['dataset_limit']}, {_CONFIG['scene_limit']}, {_CONFIG['sample_size']}, {_RAW['max_scenes']}) AS v,
        CASE WHEN d % 7 = 1 OR d % 11 = 1 THEN 'max_dataset_scenes' WHEN d % 5 = 2 THEN 'dataset_limit' WHEN d % 4 = 3 THEN 'scene_limit' WHEN d % 13 = 12 THEN 'sample_size' WHEN d % 3 = 0 THEN 'max_scenes' END AS k
        FROM (SELECT DISTINCT CAST(dataset AS INT) AS d FROM counts) q) r)"""
_KEPT = f"{_COUNTS}, {_LIMITS}, kept AS (SELECT c.dataset, l.value, l.source, l.reason, count(*) AS matched, count(*) FILTER (p <= coalesce(l.value, p)) AS selected FROM (SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY scene) AS p FROM counts) c JOIN limits l ON l.dataset = c.dataset GROUP BY ALL)"


def _settings(of: dict[str, str]) -> Column:
    return F.create_map(*(x for k, v in of.items() for x in (F.lit(k), F.expr(f"CAST({v} AS STRING)"))))


def _limited(t: Tables) -> DataFrame:
    """Matched and selected scenes of each dataset, with its limit."""
    place = F.row_number().over(Window.partitionBy("dataset").orderBy("scene"))
    rows = scene_object_counts(t).withColumn("d", F.col("dataset").cast("int")).withColumn("p", place)
    rows = rows.withColumn("limit", sp.dataset_limit(_settings(_RAW), _settings(_CONFIG)))
    inside = F.col("p") <= F.coalesce("limit.value", "p")
    return rows.groupBy("dataset", "limit.value", "limit.source", "limit.reason").agg(F.count(F.lit(1)).alias("matched"), F.count_if(inside).alias("selected"))


@query("mt10_dataset_limit", f"WITH {_KEPT} SELECT dataset, value, source, reason, selected FROM kept")
def dataset_limit(t: Tables) -> DataFrame:
    """Scenes of a dataset up to the first limit that is set, with where it is set and why."""
    return _limited(t).select("dataset", "value", "source", "reason", "selected")


@query(
    "mt11_lineage_checks",
    f"""WITH {_KEPT} SELECT dataset, CASE WHEN dataset % 8 = 5 THEN 'FAILED: inventory matched_count does not match matched scene rows' WHEN value IS NOT NULL THEN 'OK with explicit limit'
    WHEN dataset % 10 = 0 AND matched > 0 THEN 'FAILED: selected scenes differ from inventory without explicit dataset limit' ELSE 'OK' END AS state FROM kept""",
)
def lineage_checks(t: Tables) -> DataFrame:
    """Inventories that list one scene more, and selections that lack one, are told."""
    listed = F.col("matched") + (F.col("dataset") % 8 == 5).cast("int")
    selected = F.col("selected") - (F.col("dataset") % 10 == 0).cast("int")
    return _limited(t).select("dataset", sp.input_invariant(F.col("matched"), listed, selected, F.col("value")).alias("state"))


@query("ag25_fingerprint", f"WITH {_COUNTS} SELECT dataset, sha256(string_agg(CAST(scene AS VARCHAR) || ':' || CAST(objects AS VARCHAR), ',' ORDER BY scene)) AS fingerprint FROM counts GROUP BY 1")
def fingerprint(t: Tables) -> DataFrame:
    """sha256 of a dataset's scenes and counts in canonical order."""
    item = F.struct("scene", F.concat(F.col("scene").cast("string"), F.lit(":"), F.col("objects").cast("string")).alias("s"))
    rows = scene_object_counts(t).groupBy("dataset").agg(F.array_sort(F.collect_list(item)).alias("l"))
    return rows.select("dataset", F.sha2(F.array_join(F.transform("l", lambda x: x["s"]), ","), 256).alias("fingerprint"))


@query(
    "ag25_canonical_fingerprint",
    f"""WITH {_COUNTS}, j AS (SELECT dataset, '{{"class_name": "class ' || CAST(dataset AS VARCHAR) || '", "objects_count": ' || CAST(sum(objects) AS VARCHAR) || ', "scenes_count": ' || CAST(count(*) AS VARCHAR) ||
        ', "selected_scenes": [' || string_agg('"' || CAST(scene AS VARCHAR) || '"', ', ' ORDER BY CAST(scene AS VARCHAR)) || '], "split_strategy": null}}' AS payload FROM counts GROUP BY 1)
    SELECT dataset, sha256(payload) AS fingerprint, CASE WHEN dataset % 3 = 0 THEN 'commit' || CAST(dataset AS VARCHAR) ELSE sha256(payload) END AS version FROM j""",
)
def canonical_fingerprint(t: Tables) -> DataFrame:
    """sha256 of a dataset's description as JSON with sorted keys; a commit, where there is one, is the version."""
    d = F.col("dataset").cast("string")
    rows = scene_object_counts(t).groupBy("dataset").agg(F.sum("objects").alias("objects"), F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.col("scene").cast("string"))).alias("scenes"))
    payload = {"class_name": F.concat(F.lit("class "), d), "objects_count": F.col("objects"), "scenes_count": F.col("n"), "selected_scenes": F.col("scenes"), "split_strategy": F.lit(None).cast("string")}
    told = rows.select("dataset", F.sha2(N.canonical_json(payload, rows), 256).alias("fingerprint"))
    return told.withColumn("version", F.when(F.col("dataset") % 3 == 0, F.concat(F.lit("commit"), d)).otherwise(F.col("fingerprint")))


@query("ag24_class_inventory", f"WITH {_COUNTS} SELECT dataset, sum(objects) AS objects, count(*) AS scenes, bool_or(objects = 0) AS has_empty FROM counts GROUP BY 1")
def class_inventory(t: Tables) -> DataFrame:
    return scene_object_counts(t).groupBy("dataset").agg(F.sum("objects").alias("objects"), F.count(F.lit(1)).alias("scenes"), F.bool_or(F.col("objects") == 0).alias("has_empty"))


_IOU = """pairs AS (SELECT a.scene, p.pid, a.gid, (least(a.x1, p.x1) - greatest(a.x0, p.x0)) * (least(a.y1, p.y1) - greatest(a.y0, p.y0)) AS i,
    (a.x1 - a.x0) * (a.y1 - a.y0) + (p.x1 - p.x0) * (p.y1 - p.y0) AS s FROM @annotations a JOIN @predictions p ON a.scene = p.scene AND a.x0 < p.x1 AND p.x0 < a.x1 AND a.y0 < p.y1 AND p.y0 < a.y1),
    ious AS (SELECT scene, pid, gid, i / (s - i) AS iou FROM pairs WHERE i / (s - i) > 0.5)"""


@query("jn14_iou_pairs", f"WITH {_IOU} SELECT scene, pid, gid, round(iou, 9) AS iou FROM ious")
def iou_pairs(t: Tables) -> DataFrame:
    return ob.iou_pairs(t.predictions, t.annotations, 0.5).withColumn("iou", F.round("iou", 9))


def matches(t: Tables) -> DataFrame:
    return ob.greedy_match(ob.iou_pairs(t.predictions, t.annotations, 0.5))


#: Pairs taken one after another, by scene: k is the place of a pair, ps and gs are what is taken by then.
_TAKEN = f"""{_IOU}, ranked AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY round(iou, 12) DESC, pid, gid) AS k FROM ious),
    steps AS (SELECT scene, k, pid, gid, iou, true AS free, [pid] AS ps, [gid] AS gs FROM ranked WHERE k = 1
        UNION ALL SELECT r.scene, r.k, r.pid, r.gid, r.iou, NOT (list_contains(s.ps, r.pid) OR list_contains(s.gs, r.gid)),
            CASE WHEN list_contains(s.ps, r.pid) OR list_contains(s.gs, r.gid) THEN s.ps ELSE list_append(s.ps, r.pid) END,
            CASE WHEN list_contains(s.ps, r.pid) OR list_contains(s.gs, r.gid) THEN s.gs ELSE list_append(s.gs, r.gid) END
        FROM steps s JOIN ranked r ON r.scene = s.scene AND r.k = s.k + 1),
    taken AS (SELECT scene, pid, gid, iou FROM steps WHERE free)"""
_COUNTED = f"""{_TAKEN}, n AS (SELECT coalesce(a.scene, p.scene) AS scene, coalesce(p.n, 0) AS preds, coalesce(a.n, 0) AS gts FROM (SELECT scene, count(*) AS n FROM @annotations GROUP BY 1) a
    FULL JOIN (SELECT scene, count(*) AS n FROM @predictions GROUP BY 1) p ON a.scene = p.scene),
    hits AS (SELECT scene, count(*) AS tp FROM taken GROUP BY 1),
    c AS (SELECT n.scene, coalesce(tp, 0) AS tp, preds - coalesce(tp, 0) AS fp, gts - coalesce(tp, 0) AS fn FROM n LEFT JOIN hits ON hits.scene = n.scene)"""
_SCORES = ", ".join(f"round(CASE WHEN {d} > 0 THEN {n} / ({d}) ELSE 0 END, 9) AS {k}" for k, n, d in (("precision", "tp", "tp + fp"), ("recall", "tp", "tp + fn"), ("f1", "2 * tp", "2 * tp + fp + fn")))


@query("mt1_greedy_match", f"WITH RECURSIVE {_TAKEN} SELECT scene, pid, gid, round(iou, 9) AS iou FROM taken")
def greedy_match(t: Tables) -> DataFrame:
    return matches(t).withColumn("iou", F.round("iou", 9))


@query("ag5_object_scores", f"WITH RECURSIVE {_COUNTED} SELECT *, {_SCORES} FROM c")
def object_scores_by_scene(t: Tables) -> DataFrame:
    rows = ob.scene_counts(t.predictions, t.annotations, matches(t))
    return rows.select("*", *(F.round(c, 9).alias(k) for k, c in object_scores(F.col("tp"), F.col("fp"), F.col("fn")).items()))


@query("ag6_micro_average", f"WITH RECURSIVE {_COUNTED}, s AS (SELECT * FROM c UNION ALL SELECT NULL, CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT) FROM c) SELECT *, {_SCORES} FROM s")
def micro_average(t: Tables) -> DataFrame:
    rows = ob.scene_counts(t.predictions, t.annotations, matches(t)).rollup("scene").agg(*(F.sum(k).alias(k) for k in ("tp", "fp", "fn")))
    return rows.select("*", *(F.round(c, 9).alias(k) for k, c in object_scores(F.col("tp"), F.col("fp"), F.col("fn")).items()))


@query("jn16_scene_union", "SELECT coalesce(a.scene, p.scene) AS scene, coalesce(p.n, 0) AS preds, coalesce(a.n, 0) AS gts FROM (SELECT scene, count(*) AS n FROM @annotations WHERE scene % 3 <> 0 GROUP BY 1) a FULL JOIN (SELECT scene, count(*) AS n FROM @predictions WHERE scene % 5 <> 0 GROUP BY 1) p ON a.scene = p.scene")
def scene_union(t: Tables) -> DataFrame:
    n = lambda df, name: df.groupBy("scene").agg(F.count(F.lit(1)).alias(name))
    both = n(t.predictions.filter("scene % 5 <> 0"), "preds").join(n(t.annotations.filter("scene % 3 <> 0"), "gts"), "scene", "full_outer")
    return both.select("scene", F.coalesce("preds", F.lit(0)).alias("preds"), F.coalesce("gts", F.lit(0)).alias("gts"))


@query("set2_scene_ids", "SELECT DISTINCT scene FROM (SELECT scene FROM @annotations UNION SELECT scene FROM @predictions) q")
def scene_ids(t: Tables) -> DataFrame:
    return t.annotations.select("scene").union(t.predictions.select("scene")).distinct()


@query("so5_least_area", "SELECT gid, (x1 - x0) * (y1 - y0) AS area FROM @annotations WHERE (x1 - x0) * (y1 - y0) >= 300")
def least_area(t: Tables) -> DataFrame:
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return t.annotations.select("gid", area.alias("area")).filter(ob.kept_by_area(F.col("area"), 300))


@query("so4_largest_objects", "SELECT gid, scene, (x1 - x0) * (y1 - y0) AS area FROM @annotations ORDER BY area DESC, gid, scene LIMIT 100")
def largest_objects(t: Tables) -> DataFrame:
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return t.annotations.select("gid", "scene", area.alias("area")).orderBy(F.desc("area"), "gid", "scene").limit(100)
