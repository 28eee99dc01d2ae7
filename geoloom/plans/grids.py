"""Window and block grids, dependencies, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import grids as fg
from ..operators import grids as og
from .registry import query
from .views import Tables

TILE, STRIDE, CORE, HALO = 256, 192, 200, 24

_ORIGINS = "list_sort(list_distinct(list_concat(range(0, greatest({n} - {t}, 0) + 1, {s}), [greatest({n} - {t}, 0)])))"
_X, _Y = _ORIGINS.format(n="w", t=TILE, s=STRIDE), _ORIGINS.format(n="h", t=TILE, s=STRIDE)
_GRID = f"""grid AS (SELECT scene, w, h, xs[xi] AS x, ys[yi] AS y, (yi - 1) * len(xs) + xi - 1 AS index, len(xs) AS nx, len(ys) AS ny
    FROM (SELECT scene, w, h, {_X} AS xs, {_Y} AS ys FROM @scenes) s, unnest(range(1, len(xs) + 1)) AS a(xi), unnest(range(1, len(ys) + 1)) AS b(yi))"""
_BLOCKS = f"""blocks AS (SELECT scene, bi, bj, bj * {CORE} AS x0, bi * {CORE} AS y0, least(bj * {CORE} + {CORE}, w) AS x1, least(bi * {CORE} + {CORE}, h) AS y1,
    greatest(bj * {CORE} - {HALO}, 0) AS ex0, greatest(bi * {CORE} - {HALO}, 0) AS ey0, least(least(bj * {CORE} + {CORE}, w) + {HALO}, w) AS ex1, least(least(bi * {CORE} + {CORE}, h) + {HALO}, h) AS ey1
    FROM @scenes, unnest(range(0, CAST(ceil(w / {CORE}) AS BIGINT))) AS a(bj), unnest(range(0, CAST(ceil(h / {CORE}) AS BIGINT))) AS b(bi))"""


@query("gen1_axis_origins", f"SELECT scene, array_to_string({_X}, ',') AS xs FROM @scenes")
def axis_origins(t: Tables) -> DataFrame:
    return t.scenes.select("scene", F.array_join(fg.axis_origins(F.col("w"), TILE, STRIDE).cast("array<string>"), ",").alias("xs"))


@query("gen2_window_grid_train", f"WITH {_GRID} SELECT scene, x, y, {TILE} AS width, {TILE} AS height, index FROM grid")
def window_grid_train(t: Tables) -> DataFrame:
    return og.window_grid(t.scenes, TILE, STRIDE).drop("is_edge")


@query(
    "gen2_window_grid_inference",
    f"""WITH {_GRID} SELECT scene, x, y, least({TILE}, w - x) AS width, least({TILE}, h - y) AS height, index,
    x = 0 OR y = 0 OR x + {TILE} >= w OR y + {TILE} >= h AS is_edge FROM grid""",
)
def window_grid_inference(t: Tables) -> DataFrame:
    return og.window_grid(t.scenes, TILE, STRIDE, clip=True)


@query(
    "gen3_tiling_check",
    f"""WITH {_GRID} SELECT scene, count(*) AS windows, any_value(nx) * any_value(ny) AS expected, count(*) FILTER (x + least({TILE}, w) > w OR y + least({TILE}, h) > h) AS outside,
    max(x) + {TILE} >= any_value(w) AND max(y) + {TILE} >= any_value(h) AND min(x) = 0 AND min(y) = 0 AS covered FROM grid GROUP BY scene""",
)
def tiling_check(t: Tables) -> DataFrame:
    """Counts of windows against those expected, windows that stick out, and whether the grid reaches all edges."""
    grid = og.window_grid(t.scenes, TILE, STRIDE, keep=("w", "h"))
    out = (F.col("x") + F.least(F.lit(TILE), F.col("w")) > F.col("w")) | (F.col("y") + F.least(F.lit(TILE), F.col("h")) > F.col("h"))
    origins = [F.size(fg.axis_origins(F.max(c), TILE, STRIDE)).cast("bigint") for c in ("w", "h")]
    expected = origins[0] * origins[1]
    covered = (F.max("x") + TILE >= F.max("w")) & (F.max("y") + TILE >= F.max("h")) & (F.min("x") == 0) & (F.min("y") == 0)
    return grid.groupBy("scene").agg(F.count(F.lit(1)).alias("windows"), expected.alias("expected"), F.count_if(out).alias("outside"), covered.alias("covered"))


@query("gen4_block_grid", f"WITH {_BLOCKS} SELECT * FROM blocks")
def block_grid(t: Tables) -> DataFrame:
    return og.block_grid(t.scenes, CORE, HALO)


_DEPS = f"""{_GRID}, {_BLOCKS}, deps AS (SELECT b.scene, b.bi, b.bj, g.index FROM blocks b JOIN grid g ON b.scene = g.scene
    AND g.x < b.ex1 AND b.ex0 < g.x + least({TILE}, g.w - g.x) AND g.y < b.ey1 AND b.ey0 < g.y + least({TILE}, g.h - g.y))"""


def dependencies(t: Tables) -> DataFrame:
    return og.block_tiles(og.block_grid(t.scenes, CORE, HALO), og.window_grid(t.scenes, TILE, STRIDE, clip=True), CORE, HALO)


@query("jn12_block_tiles", f"WITH {_DEPS} SELECT scene, bi, bj, count(*) AS tiles, sum(index) AS index_sum, max(index) AS last_tile FROM deps GROUP BY 1, 2, 3")
def block_tiles(t: Tables) -> DataFrame:
    return dependencies(t).groupBy("scene", "bi", "bj").agg(F.count(F.lit(1)).alias("tiles"), F.sum("index").alias("index_sum"), F.max("index").alias("last_tile"))


@query("wn8_stream_overlap", f"WITH {_DEPS} SELECT scene, greatest(0, max(index) - min(lt)) AS overlap FROM (SELECT scene, bi, bj, max(index) AS index, max(index) AS lt FROM deps GROUP BY 1, 2, 3) q GROUP BY 1")
def stream_overlap(t: Tables) -> DataFrame:
    """How many tiles are still to come when a scene's first block can start."""
    ready = dependencies(t).groupBy("scene", "bi", "bj").agg(F.max("index").alias("ready"))
    return ready.groupBy("scene").agg(F.greatest(F.lit(0).cast("bigint"), F.max("ready") - F.min("ready")).alias("overlap"))


_KIND = "CASE gid % 5 WHEN 0 THEN 'positive' WHEN 1 THEN 'partial_positive' WHEN 2 THEN 'hard_negative' WHEN 3 THEN 'negative' END"


@query(
    "gen6_virtual_repeats",
    f"""SELECT gid, kind, CAST(gid AS VARCHAR) || CASE WHEN n > 1 THEN ':repeat' || CAST(r AS VARCHAR) ELSE '' END AS record_id, CASE WHEN n > 1 THEN r END AS repeat_index, CASE WHEN r > 0 THEN 'virtual_repeat' ELSE 'grid' END AS source
    FROM (SELECT gid, {_KIND} AS kind, CASE gid % 5 WHEN 0 THEN 4 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END AS n FROM @annotations) a, unnest(range(0, n)) AS u(r)""",
)
def virtual_repeats(t: Tables) -> DataFrame:
    """Positive tiles four times, hard negatives twice, all others once."""
    rows = t.annotations.select("gid", F.expr(_KIND).alias("kind"), F.col("gid").cast("string").alias("base_record_id"), F.lit("grid").alias("source"))
    return og.repeats_by_kind(rows, 4, 2, 1).select("gid", "kind", "record_id", F.col("repeat_index").cast("bigint").alias("repeat_index"), "source")


@query("gen7_virtual_epoch", "SELECT scene, count(*) * 5 AS samples FROM @annotations GROUP BY 1")
def virtual_epoch(t: Tables) -> DataFrame:
    return og.repeats(t.annotations.select("scene", F.lit("grid").alias("source")), F.lit(5)).groupBy("scene").agg(F.count(F.lit(1)).alias("samples"))


@query("gen8_batches", "SELECT scene, gid, (row_number() OVER (PARTITION BY scene ORDER BY gid, x0) - 1) // 8 AS batch FROM @annotations")
def batches(t: Tables) -> DataFrame:
    return og.batches(t.annotations, ["gid", "x0"], ["scene"], 8).select("scene", "gid", "batch")


@query("fn22_insert_slices", f"WITH {_GRID} SELECT scene, index, CASE WHEN x = 0 THEN 0 ELSE 32 END AS left_cut, CASE WHEN x + {TILE} >= w THEN 0 ELSE 32 END AS right_cut, x + CASE WHEN x = 0 THEN 0 ELSE 32 END AS insert_x FROM grid")
def insert_slices(t: Tables) -> DataFrame:
    grid = og.window_grid(t.scenes, TILE, STRIDE, keep=("w",))
    left, right = fg.insert_margin(F.col("x") == 0, 32), fg.insert_margin(F.col("x") + TILE >= F.col("w"), 32)
    return grid.select("scene", "index", left.alias("left_cut"), right.alias("right_cut"), (F.col("x") + left).alias("insert_x"))


@query("fn23_tile_weight", "SELECT obs, round(least(0.05 + 0.95 * x / 63, 0.05 + 0.95 * (63 - x) / 63) * least(0.05 + 0.95 * y / 63, 0.05 + 0.95 * (63 - y) / 63), 9) AS weight FROM @observations")
def tile_weight(t: Tables) -> DataFrame:
    weight = fg.ramp(F.col("x"), F.lit(64)) * fg.ramp(F.col("y"), F.lit(64))
    return t.observations.select("obs", F.round(weight, 9).alias("weight"))


@query("fn30_effective_stride", "SELECT scene, greatest(1, CAST(floor(192 * ((scene % 10) / 10.0)) AS INT)) AS stride FROM @scenes")
def effective_stride(t: Tables) -> DataFrame:
    return t.scenes.select("scene", fg.effective_stride(192, (F.col("scene") % 10) / F.lit(10.0)).alias("stride"))


@query("fn21_window_bounds", "SELECT scene, gid, ox + 2 * x0 AS bx0, oy - 2 * y1 AS by0, ox + 2 * x1 AS bx1, oy - 2 * y0 AS by1 FROM @annotations JOIN @scenes USING (scene)")
def window_bounds(t: Tables) -> DataFrame:
    """Windows in the raster's system, for pixels of 2 units and y upwards."""
    rows = t.annotations.join(t.scenes, "scene")
    two, zero = F.lit(2), F.lit(0)
    b = G.window_bounds([two, zero, F.col("ox"), zero, -two, F.col("oy")], G.box())
    return rows.select("scene", "gid", *(c.alias(n) for c, n in zip(b, ("bx0", "by0", "bx1", "by1"), strict=True)))


@query("fn24_box_overlap", "SELECT gid, pid FROM @annotations a JOIN @predictions p ON a.scene = p.scene AND a.gid = abs(p.pid) AND a.x0 < p.x1 AND p.x0 < a.x1 AND a.y0 < p.y1 AND p.y0 < a.y1")
def box_overlap(t: Tables) -> DataFrame:
    a = t.annotations.select("scene", "gid", *(F.col(c).alias(f"a_{c}") for c in ("x0", "y0", "x1", "y1")))
    p = t.predictions.select("scene", "pid", F.abs("pid").alias("gid"), *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))
    return a.join(p, ["scene", "gid"]).filter(G.overlaps(G.box("a_"), G.box("b_"))).select("gid", "pid")


@query("fn25_inferred_crs", "SELECT scene, CASE WHEN max(greatest(abs(x1 * scene), abs(y1))) > 1000 THEN 'EPSG:3857' ELSE 'EPSG:4326' END AS crs FROM @annotations GROUP BY 1")
def inferred_crs(t: Tables) -> DataFrame:
    rows = t.annotations.groupBy("scene").agg(F.max(F.greatest(F.abs(F.col("x1") * F.col("scene")), F.abs("y1"))).alias("m"))
    return rows.select("scene", G.inferred_crs(F.col("m")).alias("crs"))


@query("fn26_web_mercator", "SELECT c_custkey, round(radians(c_custkey % 360 - 180) * 6378137.0, 3) AS mx, round(ln(tan(pi() / 4 + radians(c_custkey % 160 - 80) / 2)) * 6378137.0, 3) AS my FROM @customer")
def web_mercator(t: Tables) -> DataFrame:
    x, y = G.web_mercator(F.col("c_custkey") % 360 - 180, F.col("c_custkey") % 160 - 80)
    return t.customer.select("c_custkey", F.round(x, 3).alias("mx"), F.round(y, 3).alias("my"))


@query("ag16_combined_bounds", "SELECT scene, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM @annotations GROUP BY 1")
def combined_bounds(t: Tables) -> DataFrame:
    return t.annotations.groupBy("scene").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("so9_sorted_blocks", f"WITH {_BLOCKS} SELECT scene, bi, bj, row_number() OVER (PARTITION BY scene ORDER BY bi, bj) AS place FROM blocks")
def sorted_blocks(t: Tables) -> DataFrame:
    return og.block_grid(t.scenes, CORE, HALO).select("scene", "bi", "bj", F.row_number().over(Window.partitionBy("scene").orderBy("bi", "bj")).alias("place"))


@query("rg4_window_polygon", "SELECT scene, gid, ox + 2 * x0 + 0.5 * y0 AS px0, oy - 2 * y0 + 0.25 * x0 AS py0, ox + 2 * x1 + 0.5 * y1 AS px2, oy - 2 * y1 + 0.25 * x1 AS py2 FROM @annotations JOIN @scenes USING (scene)")
def window_polygon(t: Tables) -> DataFrame:
    """Opposite corners of windows under a sheared affine transform."""
    affine = [F.lit(2.0), F.lit(0.5), F.col("ox"), F.lit(0.25), F.lit(-2.0), F.col("oy")]
    a, b = G.affine_point(affine, F.col("x0"), F.col("y0")), G.affine_point(affine, F.col("x1"), F.col("y1"))
    return t.annotations.join(t.scenes, "scene").select("scene", "gid", a[0].alias("px0"), a[1].alias("py0"), b[0].alias("px2"), b[1].alias("py2"))


@query("rg5_pixel_tolerance", "SELECT scene, round(2 * greatest(sqrt(pow(scene % 5 + 1, 2) + pow(scene % 3, 2)), sqrt(pow(scene % 2, 2) + pow(scene % 7 + 1, 2)), 0.000000001), 9) AS units FROM @scenes")
def pixel_tolerance(t: Tables) -> DataFrame:
    """Two pixels in the raster's units: by the longer side of a pixel."""
    s = F.col("scene")
    affine = [s % 5 + 1, s % 2, F.lit(0), s % 3, s % 7 + 1, F.lit(0)]
    return t.scenes.select("scene", F.round(G.pixel_units(affine, 2.0), 9).alias("units"))


@query("rg9_core_in_metres", f"WITH {_BLOCKS} SELECT scene, bi, bj, round(radians(x0 / 100.0) * 6378137.0, 3) AS mx0, round(ln(tan(pi() / 4 + radians(y0 / 100.0) / 2)) * 6378137.0, 3) AS my0 FROM blocks")
def core_in_metres(t: Tables) -> DataFrame:
    """Corners of cores, given in hundredths of degrees, in metres."""
    x, y = G.web_mercator(F.col("x0") / F.lit(100.0), F.col("y0") / F.lit(100.0))
    return og.block_grid(t.scenes, CORE, HALO).select("scene", "bi", "bj", F.round(x, 3).alias("mx0"), F.round(y, 3).alias("my0"))
