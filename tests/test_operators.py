"""Operators on small inputs with known results, and against plain loops."""

from __future__ import annotations

import datetime
import difflib
import json
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions import metrics as M
from geoloom.functions import names as N
from geoloom.operators import grids as og
from geoloom.operators import objects as ob
from geoloom.operators import polygons as PG
from geoloom.operators import raster as R
from geoloom.operators import scene_match as sm
from geoloom.operators import splits as sp
from geoloom.operators import tiles as T
from geoloom.operators.running import running_sum
from geoloom.operators.spatial_join import cell_join
from geoloom.sources import readers as rd
from geoloom.sources import writers as wr
from geoloom.streaming import operators as st


def boxes(spark, rows, id_col="gid", scene=1):
    return spark.createDataFrame([(scene, i, *map(int, b)) for i, b in rows], f"scene bigint, {id_col} bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")


# Scene matching


def report(spark, entries, keys):
    e = spark.createDataFrame(list(enumerate(entries)), "seq bigint, entry string")
    i = spark.createDataFrame(list(enumerate(keys)), "image bigint, key string")
    return {r.entry: (r.decision, r.reason) for r in sm.match_report(e, i).collect()}


def test_match_by_name_and_signature(spark):
    got = report(spark, ["scene-01.tif", "kanopus-20240101-112233-scn2.tif"], ["images/a/SCENE_01_cog.tif", "x/KANOPUS_20240101112233_SCN02_cog.tif"])
    assert got["scene-01.tif"] == ("matched", "normalized_exact")
    assert got["kanopus-20240101-112233-scn2.tif"] == ("matched", "kanopus_datetime_scn_signature")


def test_match_ambiguous_missing_and_folders(spark):
    keys = ["a/scene_a.tif", "b/scene_a_cog.tif", "x/other.tif", "region1/irkutsk/one.tif", "region2/irkutsk/two.tif", "Hilokskij/p.tif"]
    got = report(spark, ["scene_a.tif", "missing.tif", "irkutsk", "region1/irkutsk", "hilokskij"], keys)
    assert got["scene_a.tif"][0] == "ambiguous"
    assert got["missing.tif"][0] == "missing"
    assert got["irkutsk"][0] == "ambiguous_folder"
    assert got["region1/irkutsk"][0] == "folder_expanded"
    assert got["hilokskij"][0] == "folder_expanded"


def test_likeness_finds_all_pairs(spark):
    random.seed(3)
    words = ["".join(random.choices("abc012", k=random.randint(6, 14))) for _ in range(40)]
    near = [w[:3] + "x" + w[4:] for w in words[:20]]
    e = spark.createDataFrame(list(enumerate(near)), "seq bigint, needle string")
    i = spark.createDataFrame(list(enumerate(words)), "image bigint, name string")
    got = {(r.seq, r.image) for r in sm.like_candidates(e, i).collect()}
    want = {(a, b) for a, x in enumerate(near) for b, y in enumerate(words) if difflib.SequenceMatcher(None, x, y).ratio() >= 0.85}
    assert got == want and want


@pytest.mark.parametrize("accept", [0.85, 0.92])
def test_likeness_of_names_of_all_lengths(spark, accept):
    random.seed(7)
    heads = ["", "scene", "kanopus2024", "00000000"]
    names = [h + "".join(random.choices("0123456789az", k=random.randint(1, 14))) for h in heads for _ in range(40)]
    names += ["ортофото" + w for w in names[:10]]
    near = [w[:2] + w[3:] + "7" for w in names] + [w[::-1] for w in names[:20]] + [w[: len(w) // 2] + "q" + w[len(w) // 2 :] for w in names]
    e = spark.createDataFrame(list(enumerate(near + near[:5])), "seq bigint, needle string")
    i = spark.createDataFrame(list(enumerate(names + names[:5])), "image bigint, name string")
    got = {(r.seq, r.image) for r in sm.like_candidates(e, i, accept).collect()}
    asked, there = near + near[:5], names + names[:5]
    want = {(a, b) for a, x in enumerate(asked) for b, y in enumerate(there) if (x != y or len(x) > 1) and round(difflib.SequenceMatcher(None, x, y).ratio(), 6) >= accept}
    assert got == want and len(want) > 100
    with pytest.raises(ValueError, match="accept"):
        sm.like_candidates(e, i, 0.5)


def test_preferred_prefixes_decide_between_equal_names(spark):
    keys = ["a/one.tif", "b/one_cog.tif", "a/two.tif", "c/x/two.tif", "c/y/two.tif", "d/three.tif", "e/three.tif"]
    e = spark.createDataFrame(list(enumerate(["one.tif", "two.tif", "three.tif"])), "seq bigint, entry string")
    i = spark.createDataFrame(list(enumerate(keys)), "image bigint, key string")
    got = {r.entry: (r.decision, r.why, r.image) for r in sm.match_report(e, i, ["c/", "b/", "a/"]).collect()}
    assert got["one.tif"] == ("matched", "preferred_exact_duplicate", 1)
    assert got["two.tif"][:2] == ("ambiguous", "multiple_close_candidates")  # the first prefix that any has counts
    assert got["three.tif"][:2] == ("ambiguous", "multiple_close_candidates")


def test_matched_images_expand_folders_once(spark):
    keys = ["r/Alpha/one.tif", "r/Alpha/sub/two.TIFF", "r/Alpha/notes.txt", "r/beta/three.tif", "/R/beta/THREE.tif"]
    e = spark.createDataFrame(list(enumerate(["two.tiff", "alpha", "r/Alpha", "beta", "nothing"])), "seq bigint, entry string")
    i = spark.createDataFrame(list(enumerate(keys)), "image bigint, key string")
    report = sm.match_report(e, i)
    assert {r.entry: r.decision for r in report.collect()} == {"two.tiff": "matched", "alpha": "folder_expanded", "r/Alpha": "folder_expanded", "beta": "folder_expanded", "nothing": "missing"}
    got = sorted((r.image, r.seq, r.entry, r.score) for r in sm.matched_images(report, i).collect())
    assert got == [(0, 1, "r/Alpha/one.tif", 1.0), (1, 0, "two.tiff", 1.0), (3, 3, "r/beta/three.tif", 1.0)]


def ladder(needle, names):
    """The decision over all images, pair by pair."""

    def score(name):
        if not needle or not name:
            return 0.0, "empty"
        if needle == name:
            return 1.0, "normalized_exact"
        sig = [(m[1], m[2], int(m[3])) if (m := re.search(r"kanopus(\d{8})(\d{6}).*?scn(\d{1,2})", x)) else None for x in (needle, name)]
        if sig[0] and sig[0] == sig[1]:
            return 0.995, "kanopus_datetime_scn_signature"
        if len(needle) >= 16 and (needle in name or name in needle):
            return 0.98, "normalized_substring"
        return round(difflib.SequenceMatcher(None, needle, name).ratio(), 6), "sequence_ratio"

    scored = sorted((score(x) for x in names), key=lambda x: -x[0])
    (best, reason), second = scored[0], scored[1][0]
    exact = sum(x[0] == 1.0 for x in scored)
    if best >= 0.92:
        return "matched" if exact == 1 or exact == 0 and not (second >= 0.92 and best - second <= 0.015) else "ambiguous", reason
    return ("likely_missing_file", reason) if best >= 0.85 else ("missing", None)


def test_match_report_equals_ladder_over_all_pairs(spark):
    long = "abcdefghijklmnopqrstuvwxyz0123456789"
    kanopus = "kanopus20240101112233scn02" + long + "abcdefghijkl"
    keys = [long + "x9.tif", "z" + long[1:] + ".tif", kanopus + ".tif", kanopus.replace("z", "q").replace("scn02", "scn03") + ".tif", "abcdef.tif", "ab1cd2ee.tif"]
    entries = [long + ".tif", long + "x.tif", kanopus.replace("klmn", "kmn") + ".tif", kanopus + ".tif", "ab1cd2ef.tif", "none.tif"]
    got = report(spark, entries, keys)
    want = {e: ladder(e[:-4], [k[:-4] for k in keys]) for e in entries}
    assert got == want
    assert want[long + ".tif"][0] == "ambiguous"


def test_match_report_of_short_names(spark):
    assert ladder("abcdef", ["ab1cd2ef", "none"])[0] == "likely_missing_file"
    assert report(spark, ["abcdef.tif"], ["ab1cd2ef.tif", "none.tif"])["abcdef.tif"] == ("likely_missing_file", "sequence_ratio")


def test_scene_lines(spark):
    rows = spark.createDataFrame([("﻿Hilokskij",), ("# no",), ("  ",), ("Toguchinskij\\ x",)], "v string")
    assert [r.e for r in rows.select(N.scene_entry(F.col("v")).alias("e")).collect()] == ["Hilokskij", None, None, "Toguchinskij/"]


# Grids


@pytest.mark.parametrize(("w", "h", "tile", "stride"), [(13, 11, 6, 4), (10, 9, 4, 3), (5, 3, 8, 8), (16, 8, 8, 8)])
def test_grid_covers_scene(spark, w, h, tile, stride):
    scenes = spark.createDataFrame([(1, w, h)], "scene bigint, w bigint, h bigint")
    rows = og.window_grid(scenes, tile, stride, clip=True).collect()
    seen = {(x, y) for r in rows for x in range(r.x, r.x + r.width) for y in range(r.y, r.y + r.height)}
    assert seen == {(x, y) for x in range(w) for y in range(h)}
    assert sorted(r["index"] for r in rows) == list(range(len(rows)))


def test_block_grid(spark):
    scenes = spark.createDataFrame([(1, 16, 8)], "scene bigint, w bigint, h bigint")
    rows = sorted((r.x0, r.y0, r.x1, r.y1, r.ex0, r.ey0, r.ex1, r.ey1) for r in og.block_grid(scenes, 8, 2).collect())
    assert rows == [(0, 0, 8, 8, 0, 0, 10, 8), (8, 0, 16, 8, 6, 0, 16, 8)]


def test_constant_in_constant_out(spark):
    rows = spark.createDataFrame([(1, y, x, 0.25, w) for y in range(4) for x in range(4) for w in (1, 3)], "scene bigint, y bigint, x bigint, p double, w bigint")
    assert all(abs(r.prob - 0.25) < 1e-9 for r in R.stitched(rows, F.col("p"), F.col("w")).collect())


# Spatial joins


def test_cell_join_equals_nested_loop(spark):
    random.seed(5)

    def some(n, p):
        out = []
        for k in range(n):
            x, y = random.randint(-50, 200), random.randint(-50, 200)
            out.append((k % 2, k, x, y, x + random.randint(1, 90), y + random.randint(1, 60)))
        return spark.createDataFrame(out, f"scene bigint, {p}id bigint, {p}_x0 bigint, {p}_y0 bigint, {p}_x1 bigint, {p}_y1 bigint"), out

    a, ra = some(60, "a")
    b, rb = some(60, "b")
    for touching in (False, True):
        got = sorted((r.aid, r.bid) for r in cell_join(a, b, ["scene"], 32, touching).collect())
        lt = (lambda x, y: x <= y) if touching else (lambda x, y: x < y)
        want = sorted((p[1], q[1]) for p in ra for q in rb if p[0] == q[0] and lt(p[2], q[4]) and lt(q[2], p[4]) and lt(p[3], q[5]) and lt(q[3], p[5]))
        assert got == want


def test_adjacency(spark):
    named = {1: (0, 0, 100, 100), 2: (-100, 0, 0, 100), 3: (100, 0, 200, 100), 4: (0, 100, 100, 200), 5: (0, -100, 100, 0), 6: (50, 0, 150, 100), 7: (1000, 0, 1100, 100)}
    feet = spark.createDataFrame([(k, *b) for k, b in named.items()], "scene bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    got = {r.neighbour: (r.relation, r.side) for r in T.adjacency(feet, 2, 0, 64).filter("anchor = 1").collect()}
    assert got == {2: ("touch", "left"), 3: ("touch", "right"), 4: ("touch", "top"), 5: ("touch", "bottom"), 6: ("overlap", "overlap")}


def test_mosaic_plan(spark):
    def plan(feet, edges):
        win = spark.createDataFrame([(1, 0, 0, 0, 100, 100)], "scene bigint, index bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
        f = spark.createDataFrame([(k, *b) for k, b in feet.items()], "scene bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
        e = spark.createDataFrame(edges, "anchor bigint, neighbour bigint")
        return T.mosaic_plan(win, f, e).first()

    assert plan({1: (0, 0, 100, 100)}, [(1, 9)]).reason == "fully_inside_footprint"
    assert plan({1: (0, 0, 50, 100)}, [(1, 9)]).reason == "no_neighbor_for_gap"
    got = plan({1: (0, 0, 50, 100), 2: (50, 0, 100, 100)}, [(1, 2)])
    assert (got.reason, got.candidates) == ("neighbor_covers_gap", 1)


# Metrics


@pytest.mark.parametrize(
    ("pred", "truth", "want"),
    [([0, 1, 1, 0], [1, 1, 0, 0], (1, 1, 1, 1)), ([1, 1, 1, 0], [1, 255, 0, 0], (1, 1, 0, 1)), ([0, 0], [1, 1], (0, 0, 2, 0)), ([0, 0], [0, 0], (0, 0, 0, 2))],
)
def test_confusion(spark, pred, truth, want):
    df = spark.createDataFrame(list(zip(pred, truth, strict=True)), "p int, t int")
    r = df.agg(*(c.alias(k) for k, c in M.confusion(F.col("p"), F.col("t")).items())).first()
    assert (r.tp, r.fp, r.fn, r.tn) == want


def test_empty_scores(spark):
    zero = spark.createDataFrame([(0, 0, 0)], "tp bigint, fp bigint, fn bigint")
    cols = (F.col("tp"), F.col("fp"), F.col("fn"))
    assert zero.select(*M.pixel_scores(*cols).values()).first() == (1.0, 1.0, 1.0, 1.0)
    assert zero.select(*M.object_scores(*cols).values()).first() == (0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    ("preds", "gts", "want"),
    [
        ([(0, 0, 10, 10)], [(0, 0, 10, 10)], (1, 0, 0)),
        ([(0, 0, 10, 10)], [(20, 20, 30, 30)], (0, 1, 1)),
        ([(0, 0, 10, 10)], [(0, 0, 8, 10)], (1, 0, 0)),
        ([(0, 0, 10, 10)], [(5, 0, 15, 10)], (0, 1, 1)),
        ([(0, 0, 10, 10), (0, 0, 9, 10)], [(0, 0, 10, 10)], (1, 1, 0)),
        ([(0, 0, 10, 10)], [(0, 0, 10, 10), (0, 0, 9, 10)], (1, 0, 1)),
        ([(0, 0, 10, 10)] * 2, [(0, 0, 10, 10)] * 2, (2, 0, 0)),
        ([(0, 0, 0, 10)], [(0, 0, 10, 10)], (0, 1, 1)),
    ],
)
def test_object_match(spark, preds, gts, want):
    p, g = boxes(spark, enumerate(preds), "pid"), boxes(spark, enumerate(gts))
    r = ob.scene_counts(p, g, ob.greedy_match(ob.iou_pairs(p, g, 0.5))).first()
    assert (r.tp, r.fp, r.fn) == want


def test_greedy_match_equals_loop(spark):
    random.seed(8)

    def rnd(n):
        out = []
        for k in range(n):
            x, y = random.randint(0, 60), random.randint(0, 60)
            out.append((k, (x, y, x + random.randint(8, 24), y + random.randint(8, 24))))
        return out

    a, b = rnd(80), rnd(80)
    pairs = ob.iou_pairs(boxes(spark, a, "pid"), boxes(spark, b), 0.2)
    got = {(r.pid, r.gid) for r in ob.greedy_match(pairs).collect()}
    p, g, want = set(), set(), set()
    for _, i, j in sorted((-round(r.iou, 12), r.pid, r.gid) for r in pairs.collect()):
        if i not in p and j not in g:
            p.add(i), g.add(j), want.add((i, j))
    assert got == want and want


# Rasters


def test_components_equal_flood_fill(spark):
    """Also in wide scenes."""
    random.seed(2)
    on = {(y, x + 70_000) for y in range(20) for x in range(20) if random.random() < 0.5}
    rows = R.label_components(spark.createDataFrame([(1, y, x) for y, x in on], "scene bigint, y bigint, x bigint")).collect()
    want, left = {}, set(on)
    while left:
        seed = min(left)
        stack, part = [seed], set()
        while stack:
            y, x = stack.pop()
            if (y, x) in left:
                left.discard((y, x))
                part.add((y, x))
                stack += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
        for p in part:
            want[p] = seed
    assert {(r.y, r.x): tuple(r.label) for r in rows} == want


def random_boxes(n, most=20, size=9):
    out = []
    for k in range(n):
        x, y = random.randint(0, most), random.randint(0, most)
        out.append((k, (x, y, x + random.randint(1, size), y + random.randint(1, size))))
    return out


def painted(b):
    return {(y, x) for _, (x0, y0, x1, y1) in b for x in range(x0, x1) for y in range(y0, y1)}


def test_covered_area_equals_painting(spark):
    random.seed(4)
    b = random_boxes(15)
    assert PG.covered_area(boxes(spark, b), ["scene"]).first().area == len(painted(b))


def ring(spark, *rings):
    rows = [(1, g, r, k, float(x), float(y)) for g, parts in enumerate(rings) for r, part in enumerate(parts) for k, (x, y) in enumerate(part)]
    return PG.ring_edges(spark.createDataFrame(rows, "scene bigint, gid bigint, ring int, k int, x double, y double"), ["scene", "gid"], ["ring"])


BOW = [(0, 0), (10, 10), (10, 0), (0, 10)]
STAR = [(5, 0), (8, 10), (0, 4), (10, 4), (2, 10)]


def test_cleaned_areas(spark):
    """A ring that crosses itself, one with a hole, one that runs over its own edge twice, one without an area."""
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    spike = [(0, 0), (10, 0), (10, 10), (20, 10), (10, 10), (0, 10)]
    rows = PG.shape_areas(PG.cleaned(ring(spark, [BOW], [square, [(2, 2), (4, 2), (4, 4), (2, 4)]], [spike], [[(0, 0), (5, 5), (9, 9)]], [STAR]), ["scene", "gid"]), ["scene", "gid"]).collect()
    got = {r.gid: r.area for r in rows}
    assert {k: round(v, 9) for k, v in got.items() if k != 4} == {0: 50.0, 1: 96.0, 2: 100.0}
    fine = 400
    inside = sum(even_odd(STAR, (x + 0.5) * 10 / fine, (y + 0.5) * 10 / fine) for x in range(fine) for y in range(fine)) * (10 / fine) ** 2
    assert got[4] == pytest.approx(inside, rel=0.01)


def even_odd(points, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True):
        if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) <= x:
            odd = not odd
    return odd


def test_cleaned_rings_with_many_crossings(spark):
    random.seed(11)
    points = [(random.randint(0, 40), random.randint(0, 40)) for _ in range(60)]
    got = PG.shape_areas(PG.cleaned(ring(spark, [points]), ["scene", "gid"], 16), ["scene", "gid"]).first().area
    fine = 200
    inside = sum(even_odd(points, (x + 0.5) * 40 / fine, (y + 0.5) * 40 / fine) for x in range(fine) for y in range(fine)) * (40 / fine) ** 2
    assert got == pytest.approx(inside, rel=0.02)


def test_cleaned_rows_give_what_joins_give(spark):
    """Polygons of few edges are settled as rows, without a join; larger ones, among them, by joins."""
    random.seed(12)
    rings = [[[(random.randint(0, 20), random.randint(0, 20)) for _ in range(n)]] for n in (3, 4, 4, 5, 7, 8, 9, 30)]
    edges = ring(spark, *rings, [BOW], [STAR])
    areas = lambda df: {r.gid: round(r.area, 9) for r in PG.shape_areas(df, ["scene", "gid"]).collect()}
    want = areas(PG.cleaned_by_joins(edges, ["scene", "gid"], 16))
    assert len(want) == 10
    for whole in (2, 8, 64):
        assert areas(PG.cleaned(edges, ["scene", "gid"], 16, whole)) == want
    assert "Join" not in PG.cleaned(edges, ["scene", "gid"], 16)._jdf.queryExecution().optimizedPlan().toString()


def test_filled_and_touched_pixels(spark):
    edges = ring(spark, [BOW], [STAR])
    got = {(r.gid, r.y, r.x) for r in PG.span_pixels(PG.filled_spans(edges, ["scene", "gid"], 1), ["scene", "gid"]).collect()}
    assert got == {(g, y, x) for g, p in enumerate((BOW, STAR)) for y in range(11) for x in range(11) if even_odd(p, x + 0.5, y + 0.5)}
    touched = {(r.gid, r.y, r.x) for r in PG.span_pixels(PG.touched_spans(edges, ["scene", "gid"], 1), ["scene", "gid"]).collect()}
    assert got < touched and {(0, k, k) for k in range(10)} <= touched


def test_dissolved_spans_equal_painting(spark):
    random.seed(6)
    b = random_boxes(25, 40)
    whole = painted(b)
    rows = [(1, y, x0, x1) for _, (x0, y0, x1, y1) in b for y in range(y0, y1)]
    spans = spark.createDataFrame(rows, "scene bigint, row bigint, c0 bigint, c1 bigint")
    pixels = lambda df: {(r.y, r.x) for r in PG.span_pixels(df, ["scene"]).collect()}
    assert pixels(PG.dissolved(spans, ["scene"])) == whole
    around = [(dy, dx) for dy in range(-2, 3) for dx in range(-2, 3)]
    wide = {(y + dy, x + dx) for y, x in whole for dy, dx in around}
    closed = {p for p in wide if all((p[0] + dy, p[1] + dx) in wide for dy, dx in around)}
    assert pixels(PG.dissolved(spans, ["scene"], 2)) == closed
    sizes, left = [], set(whole)
    while left:
        stack, n = [left.pop()], 0
        while stack:
            y, x = stack.pop()
            n += 1
            near = {(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)} & left
            left -= near
            stack += near
        sizes.append(n)
    got = PG.span_objects(PG.dissolved(spans, ["scene"]), ["scene"], 15).collect()
    assert sorted(r.pixels for r in got) == sorted(n for n in sizes if n >= 15)


def test_mosaic_plan_of_two_half_covering_neighbours(spark):
    """Two neighbours that overlap each other cover the gap together; shares do not add up beyond it."""
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    foot = frame([(1, 0, 0, 50, 100), (2, 50, 0, 100, 60), (3, 50, 40, 100, 100), (4, 50, 0, 80, 10)], "scene bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    window = frame([(1, 0, 0, 0, 100, 100)], "scene bigint, index bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    edge = lambda n: (1, n, "touch", "right", 0.0)
    names = "anchor bigint, neighbour bigint, relation string, side string, distance double"
    for who, cover, n in (([2, 3], 1.0, 2), ([2], 0.6, 1), ([3, 4], 0.66, 2)):
        r = T.mosaic_plan(window, foot, frame([edge(k) for k in who], names)).first()
        assert (r.gap, r.reason, r.candidates, r.side, r.cover, r.overlap) == (5000, "neighbor_covers_gap", n, "right", cover, False)


def test_simplified(spark):
    line = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 1.0, 0.1), (1, 2, 2.0, 0.0), (1, 3, 3.0, 5.0)], "ring bigint, k bigint, x double, y double")
    assert sorted(r.k for r in R.simplified(line, 0.5).collect()) == [0, 2, 3]


# Splits


def loop_split(rows, fraction, target=None, least=1, with_empty=True):
    """rows: (scene, objects, order) of one dataset."""
    least = least if len(rows) > 1 else 1
    some = sorted((r for r in rows if r[1] > 0), key=lambda r: (-r[1], r[2], r[0]))
    none = sorted((r for r in rows if r[1] <= 0), key=lambda r: (r[2], r[0]))
    total = sum(r[1] for r in rows)
    aim = max(1, round(total * fraction) if target is None else target) if total else 0
    val, have = [], 0
    for k, r in enumerate(some):
        if not val:
            if r[1] > aim and any(o[1] <= aim for o in some[k + 1 :]):
                continue
        elif have >= aim and len(val) >= least:
            break
        elif not ((have < aim and have + r[1] <= aim) or abs(aim - have - r[1]) <= abs(aim - have) or len(val) < least):
            continue
        val.append(r[0])
        have += r[1]
    zeros = round(len(none) * fraction)
    if none and len(rows) > 1:
        zeros = max(1, zeros)
    zero_ids = [r[0] for r in none[:zeros]] if with_empty else []
    val += zero_ids
    if not val and len(rows) > 1:
        val = [max(r[0] for r in rows)]
    if len(val) == len(rows) > 1:
        val.remove(zero_ids[0] if zero_ids else val[0])
    return set(val)


def test_object_balanced_split_equals_loop(spark):
    import hashlib

    random.seed(6)
    data = []
    for d in range(12):
        for s in range(random.randint(1, 14)):
            data.append((d, s, random.choice([0, 0, 1, 2, 5, 30, 200])))
    df = spark.createDataFrame(data, "dataset bigint, scene bigint, objects bigint")
    got = {(r.dataset, r.scene) for r in sp.object_balanced_split(df).filter("part = 'val'").collect()}
    want = set()
    for d in range(12):
        rows = [(s, o, hashlib.md5(f"42:{d}:{s}".encode()).hexdigest()) for dd, s, o in data if dd == d]
        want |= {(d, s) for s in loop_split(rows, 0.2)}
    assert got == want
    for target, least, with_empty in ((5, 1, True), (None, 4, True), (30, 3, False), (0, 20, False)):
        split = sp.object_balanced_split(df, with_empty=with_empty, target_objects=target, min_scenes=least)
        got, want = {(r.dataset, r.scene) for r in split.filter("part = 'val'").collect()}, set()
        for d in range(12):
            rows = [(s, o, hashlib.md5(f"42:{d}:{s}".encode()).hexdigest()) for dd, s, o in data if dd == d]
            want |= {(d, s) for s in loop_split(rows, 0.2, target, least, with_empty)}
        assert got == want


def test_losses_by_name(spark):
    """Parts and their sums against a plain version; names' parts in any order."""
    import math

    pixels = [(0.5, 1), (-2.0, 0), (3.0, 1), (1.0, 0)]
    df = spark.createDataFrame(pixels, "x double, y int")
    p = [1 / (1 + math.exp(-x)) for x, _ in pixels]
    bce = [-(math.log(q) if y else math.log(1 - q)) for q, (_, y) in zip(p, pixels, strict=True)]
    tp, total = sum(q * y for q, (_, y) in zip(p, pixels, strict=True)), sum(p) + sum(y for _, y in pixels)
    parts = {
        "bce": sum(bce) / 4, "dice": 1 - (2 * tp + 1e-7) / (total + 1e-7), "tversky": 1 - (tp + 1e-7) / (total / 2 + 1e-7),
        "focal": sum((1 - (q if y else 1 - q)) ** 2 * b for q, (_, y), b in zip(p, pixels, bce, strict=True)) / 4,
    }
    for name, of in {"bce": "bce", "tversky_bce": "bce tversky", "dice_focal": "focal dice", "bce_dice_focal": "bce focal dice", "unknown": "bce dice", "binary_cross_entropy": "bce"}.items():
        got = df.agg(M.segmentation_loss(name, F.col("x"), F.col("y")).alias("v")).first().v
        assert got == pytest.approx(sum(parts[k] for k in of.split()))


def test_running_sum_over_ranges(spark):
    random.seed(12)
    rows = [(random.randint(0, 300), random.randint(-5, 5)) for _ in range(500)]
    got = {(r.pos, r.total) for r in running_sum(spark.createDataFrame(rows, "pos int, v int").repartition(7), "pos", "v").collect()}
    assert got == {(p, sum(v for q, v in rows if q <= p)) for p, _ in rows}


@pytest.mark.parametrize("most", [0, 1500, 4000, 10**6])
def test_kept_tail(spark, most):
    """As a file of lines is cut: its last bytes, less the line that they begin in."""
    random.seed(13)
    logs = {j: [f"{j}:{k}:" + "x" * random.randint(0, 300) for k in range(20 + 10 * j)] for j in range(3)}
    df = spark.createDataFrame([(j, k, line) for j, lines in logs.items() for k, line in enumerate(lines)], "job int, k int, line string")
    got = wr.kept_tail(df, ["job"], "k", F.octet_length("line"), most).filter("kept").collect()
    for j, lines in logs.items():
        text = "".join(f"{x}\n" for x in lines)
        want = [] if most <= 0 else lines if len(text) <= most else text[-max(1024, most) :].splitlines()[1:]
        assert [r.line for r in sorted(got, key=lambda r: r.k) if r.job == j] == want


def test_canonical_json(spark):
    rows = [(1, 'a "quoted" \\ name', ["x", "y z"], None), (2, None, [], 5)]
    df = spark.createDataFrame(rows, "id int, name string, parts array<string>, n bigint")
    got = df.select("id", N.canonical_json({"name": F.col("name"), "parts": F.col("parts"), "n": F.col("n"), "a": F.col("id")}, df).alias("j")).collect()
    for (i, name, parts, n), r in zip(rows, sorted(got), strict=True):
        assert r.j == json.dumps({"name": name, "parts": parts, "n": n, "a": i}, ensure_ascii=False, sort_keys=True)


def test_match_names(spark):
    scenes = spark.createDataFrame([(1, "a/Scene_A.tif"), (2, "b/scene_a.TIF"), (3, "c/other.tif")], "scene int, key string")
    features = spark.createDataFrame([(1, "scene_a.TIF"), (2, "SCENE_A.tif"), (3, "Scene_A"), (4, "OTHER.tif"), (5, "nothing")], "id int, name string")
    got = {r.id: r.scene for r in sm.match_names(features, "id", "name", scenes, "scene", "key").collect()}
    assert got == {1: 2, 2: 1, 3: 1, 4: 3}


# Sources, sinks, streams


def test_geojson(spark):
    texts = [
        (1, '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"image_name":"a"},"geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","properties":{},"geometry":null}]}'),
        (2, '{"type":"Feature","properties":{"image_name":"b"},"geometry":{"type":"Point","coordinates":[1,2]}}'),
        (3, '{"type":"Point","coordinates":[1,2]}'),
        (4, "nonsense"),
    ]
    rows = rd.geojson_features(spark.createDataFrame(texts, "id bigint, json string"), "id", "json").collect()
    got = {(r.id, r.idx): (r.properties or {}).get("image_name") for r in rows}
    assert got == {(1, 0): "a", (1, 1): None, (2, 0): "b", (3, 0): None, (4, 0): None}
    assert {r.id for r in rows if r.warning} == {1, 4}


def test_files(spark, tmp_path):
    import numpy as np

    (tmp_path / "list.txt").write_bytes(b"\xef\xbb\xbfA/b.tif\r\n# c\r\n\r\nD\\e.tif x\r\n")
    assert [r.entry for r in rd.read_scene_list(spark, str(tmp_path / "list.txt")).collect()] == ["A/b.tif", "D/e.tif"]
    np.savez(tmp_path / "t.npz", other=np.ones((1, 1)), prob_uint8=np.array([[0, 255]], np.uint8))
    rows = rd.probability_artifacts(spark, str(tmp_path)).collect()
    assert sorted((r.x, round(r.prob, 6)) for r in rows) == [(0, 0.0), (1, 1.0)]
    listing = rd.list_objects(spark, str(tmp_path), "*.{txt,npz}")
    assert [r.name for r in listing.collect()] == ["list.txt", "t.npz"]
    status = rd.layout_status(listing, ["list"]).first()
    assert status.files == 2 and status.has_list
    for form in ("json", "jsonl.gz", "tsv", "csv"):
        wr.write_report(spark.range(3), str(tmp_path / form.replace(".", "_")), form)
    assert spark.read.json(str(tmp_path / "jsonl_gz")).count() == 3


def test_flatten_json(spark):
    df = spark.createDataFrame([(1, json.dumps({"a": {"b": 1, "c": {"d": "x"}}, "e": None}))], "i bigint, j string")
    assert {r.key: r.value for r in sm.flatten_json(df, "i", "j").collect()} == {"a.b": "1", "a.c.d": "x", "e": None}


def test_prometheus_line(spark):
    df = spark.createDataFrame([('q"1', 3)], "queue string, n int")
    line = df.select(wr.prometheus_line("depth", ["queue"], F.col("n")).alias("l")).first().l
    assert line == 'depth{queue="q\\"1"} 3' and re.fullmatch(r'\w+\{\w+="(?:[^"\\]|\\.)*"\} \d+', line)


def test_message_id(spark):
    df = spark.createDataFrame([("job", "scene", "", None, "tile.infer")], "a string, b string, c string, d string, e string")
    assert df.select(st.message_id(*map(F.col, "abcde")).alias("m")).first().m == "job/scene/tile.infer"


def test_ready_blocks(spark):
    needs = spark.createDataFrame([(1, t, t // 2) for t in range(4)], "scene bigint, tile bigint, block bigint")
    done = spark.createDataFrame([(1, 0, 1), (1, 0, 9), (1, 1, 2), (1, 2, 3)], "scene bigint, tile bigint, ts bigint")
    assert [(r.block, r.ready_ts) for r in st.ready_blocks(done, needs).collect()] == [(0, 2)]


def test_hysteresis(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 3, 0), (1, 4, 3)], "k int, t int, depth int")
    rows = st.hysteresis(df, ["k"], ["t"], F.col("depth") > 4, F.col("depth") <= 1).orderBy("t").collect()
    assert [r.paused for r in rows] == [True, True, False, False]


def test_boxes(spark):
    df = spark.createDataFrame([(0, 0, 10, 10, 10, 0, 20, 10)], "x0 int, y0 int, x1 int, y1 int, b_x0 int, b_y0 int, b_x1 int, b_y1 int")
    a, b = G.box(), G.box("b_")
    assert df.select(G.overlaps(a, b), G.meets(a, b), G.iou(a, b), G.distance(a, b)).first() == (False, True, 0.0, 0.0)


def test_names_of_reports(spark):
    """Rules of names, with their exact values."""
    one = lambda f, *xs: [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x string").orderBy("k").select(f(F.col("x"))).collect()]
    assert one(N.validation_kind, "block_holdout", "random", "scenes by tile", "leave_one_scene", "scene", None) == ["spatial_holdout", "unknown", "tile_holdout", "scene_level", "unknown", "unknown"]
    assert one(N.norm_scene_name, "root/Irkutsk/", "a//", "b/Scene-01_cog.TIF") == ["irkutsk", "a", "scene01"]
    assert one(N.run_slug, "a b/c", "", "x" * 200, "ok-1._") == ["a_b_c", "run", "x" * 180, "ok-1._"]
    assert one(N.is_run_id, "a.B-1_", "a b", "") == [True, False, False]
    assert one(N.excluded_metric, "val/f1", "Resourse.x", "validity", "f1_pixel", "a/best_threshold", "x.pixel.tp", "xpixel_tp") == [True, True, False, False, True, True, False]
    assert one(N.metric_threshold, "best_val_pixel_f1@0.5", "dice_thr_1", "f1_pixel", "loss_0.5", "val_f1-t0.45") == [0.5, 1.0, None, None, 0.45]
    assert one(N.pixel_f1_place, "F1-Pixel", "metrics.pixel_f1", "loss") == [0, 10, None]
    assert one(N.scene_stem, "a/b.TIF", "b.tif.aux.xml", "c/d.tiff/") == ["b", "b.tif.aux.xml", "d"]


def test_dataset_limit_and_invariant(spark):
    from geoloom.operators.splits import dataset_limit, input_invariant

    rows = [({"max_scenes": "5"}, {"dataset_limit": "0"}), ({"scene_limit": "7", "limit_reason": "pilot"}, {}), ({"sample_size": ""}, {"sample_size": "3"}), ({"max_scenes": "4"}, {}), ({}, {})]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, raw map<string,string>, config map<string,string>")
    got = [tuple(r.x) for r in df.select("k", dataset_limit(F.col("raw"), F.col("config")).alias("x")).orderBy("k").collect()]
    usual = "explicit dataset input limit configured"
    p = "pipeline_trace.preprocess."
    assert got == [(1, p + "dataset_limit", usual), (7, p + "scene_limit", "pilot"), (None, None, None), (4, p + "max_scenes", "preprocess.max_scenes compatibility limit"), (None, None, None)]
    states = spark.createDataFrame([(3, 3, 3, None), (3, 4, 3, None), (3, 3, 2, None), (3, 3, 2, 2)], "m int, l int, s int, v int")
    told = [r[0][:20] for r in states.select(input_invariant(F.col("m"), F.col("l"), F.col("s"), F.col("v"))).collect()]
    assert told == ["OK", "FAILED: inventory ma", "FAILED: selected sce", "OK with explicit lim"]


def test_scene_statistics_equal_reduced_image(spark):
    np = pytest.importorskip("numpy")
    random.seed(5)
    w, h, most = 150, 90, 64
    a = np.array([[random.choice([0, 0, *range(1, 200)]) for _ in range(w)] for _ in range(h)])
    rows = [(1, y, x, int(a[y, x])) for y in range(h) for x in range(w)] + [(2, 0, x, 7) for x in range(15)] + [(3, 0, x, 7) for x in range(16)]
    pixels = spark.createDataFrame(rows, "scene bigint, y bigint, x bigint, value int")
    scenes = spark.createDataFrame([(1, w, h), (2, 20, 1), (3, 20, 1)], "scene bigint, w bigint, h bigint")
    got = {r.scene: (r.low, r.high) for r in R.scene_statistics(pixels, scenes, most).collect()}
    scale = w / most
    nh, nw = round(h / scale), round(w / scale)
    small = a[[int((k + 0.5) * h / nh) for k in range(nh)]][:, [int((k + 0.5) * w / nw) for k in range(nw)]]
    assert got[1] == pytest.approx(tuple(np.percentile(small[small != 0], [2, 98])))
    assert got[2] == (0, 1) and got[3] == (7, 8)


def test_valid_mask_ladder(spark):
    row = "w bigint, y bigint, x bigint, dataset_mask boolean, alpha boolean, nodata boolean, nonzero_any boolean, nonzero_all boolean"
    masks = {1: [(True, None, True, True, True), (False, None, True, True, True)], 2: [(True, True, True, True, True), (True, False, True, True, True)], 3: [(True, None, True, True, True), (True, None, False, True, False)],
             4: [(True, None, None, True, False), (True, None, None, False, False)], 5: [(True, None, None, False, False)] * 2, 6: [(None, None, None, False, False)] * 2}
    pixels = spark.createDataFrame([(w, 0, x, *m) for w, ms in masks.items() for x, m in enumerate(ms)], row)
    got = {(r.w, r.x): (r.source, r.valid) for r in R.valid_mask(pixels, ["w"]).collect()}
    assert [got[w, 1] for w in range(1, 7)] == [("dataset_mask", False), ("alpha", False), ("nodata", False), ("nonzero_any", False), ("dataset_mask", True), ("empty", False)]
    assert {r.valid for r in R.valid_mask(pixels.filter("w = 3"), ["w"], "nonzero_all").collect()} == {True, False}
    with pytest.raises(ValueError):
        R.valid_mask(pixels, ["w"], "other")


def test_masked_settings(spark):
    got = spark.createDataFrame([('{"a":{"My_Token":[1,{"b":2}]},"l":[{"x":"é","PASSWORD":null}]}',), ("no json",), (None,)], "t string").select(N.mask_secrets("t")).collect()
    assert [r[0] for r in got] == ['{"a":{"My_Token":"***"},"l":[{"x":"é","PASSWORD":"***"}]}', None, None]


def test_scene_score_and_properties(spark):
    pairs = spark.createDataFrame([("scene01", "scene01"), ("", "x"), (None, "x"), ("kanopusscene2024regionseven", "scene2024"), ("abcd", "abce")], "a string, b string")
    got = [tuple(r.s) for r in pairs.select(sm.scene_score(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [(1.0, "normalized_exact"), (0.0, "empty"), (0.0, "empty"), (0.98, "normalized_substring"), (0.75, "sequence_ratio")]
    maps = spark.createDataFrame([({"src": "a/b.tif", "scene": " "},), ({"file": "see c/d.TIFF; e.tif"},), ({"image": "'x/y/'"},), ({"other": "z.tif"},), (None,)], "p map<string,string>")
    assert [r[0] for r in maps.select(N.scene_of_properties(F.col("p"))).collect()] == ["b.tif", "d.TIF", "y", None, None]


def test_history_and_collection(spark, tmp_path):
    rows = spark.createDataFrame([({"b": 1.0},), ({"a": 2.0, "b": 3.0},)], "m map<string,double>")
    assert wr.write_history(rows, "m", str(tmp_path / "h")) == ["a", "b"]
    assert sorted(map(tuple, spark.read.option("header", True).csv(str(tmp_path / "h")).collect()), key=str) == [("2.0", "3.0"), (None, "1.0")]
    text = spark.range(1).select(wr.feature_collection(F.lit('x"y'), F.array(F.lit('{"k":1}'), F.lit('{"k":2}')), 3857)).first()[0]
    assert json.loads(text) == {"type": "FeatureCollection", "name": 'x"y', "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, "features": [{"k": 1}, {"k": 2}]}


def test_greedy_match_hands_on_contested_pairs_only(spark, monkeypatch):
    """Pairs whose ends have no other pair are settled in the first round; repeated pairs count once."""
    from geoloom.operators.durable import Held

    sizes, put = [], Held.put

    def counting(self, df):
        told = put(self, df)
        sizes.append(told.count())
        return told

    monkeypatch.setattr(Held, "put", counting)
    rows = [(1, k, k, 0.9) for k in range(50)] + [(1, 0, 0, 0.9), (1, 100, 100, 0.8), (1, 100, 101, 0.9), (1, 101, 101, 0.7), (1, 101, 102, 0.6)]
    got = {(r.pid, r.gid) for r in ob.greedy_match(spark.createDataFrame(rows, "scene bigint, pid bigint, gid bigint, iou double")).collect()}
    assert got == {(k, k) for k in range(50)} | {(100, 101), (101, 102)}
    assert sizes == [54, 1, 0]
    assert ob.greedy_match(spark.createDataFrame([], "scene bigint, pid bigint, gid bigint, iou double")).count() == 0


def test_manifest_choice_of_equal_names(spark, tmp_path):
    """Images of one name and age, as there are beyond 604,800 parts, keep their order in every run, whatever order they are read in."""
    from geoloom.plans.registry import QUERIES

    ends = [3 + 604_800 * k for k in (2, 0, 3, 1)]
    rows = [(k, "x", "Brand#1", "t", 1, 900.01) for k in ends]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    got = {r.image: r.place for r in QUERIES["rg14_manifest_choice"](spark, str(tmp_path)).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(ends)


def test_ready_blocks_asks_the_store_seldom():
    """A block that is done in one go costs one read, one write and one timer, however many messages it has; times are a block's own."""
    calls, held = [], {}

    class Handle:
        def getValueState(self, name, schema):
            return self

        def get(self):
            calls.append("get")
            return held.get("state")

        def update(self, value):
            calls.append("update")
            held["state"] = value

        def registerTimer(self, at):
            calls.append("register")

        def deleteTimer(self, at):
            calls.append("delete")

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    block = st.ReadyBlocks(1000)
    block.init(Handle())
    rows = [Row(tile=k % 4, us=1_000_000 * k, n_tiles=4) for k in range(100)]
    assert list(block.handleInputRows((7, 1), iter(rows), Times())) == [Row(scene=7, block=1, ready_us=3_000_000)]
    assert calls == ["get", "register", "update"] and held["state"] == (True, 100_000, [], [])
    assert list(block.handleInputRows((7, 1), iter(rows[:1]), Times())) == []
    assert calls[3:] == ["get", "delete", "register", "update"]


def test_ready_blocks_stream_over_restarts(spark, tmp_path):
    """The last tile's first message counts; repeats are ignored, until the timer has cleared the block."""
    at = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    schema = "scene bigint, tile bigint, ts timestamp"
    needs = spark.createDataFrame([(1, k, 0, 3) for k in range(3)], "scene bigint, tile bigint, block bigint, n_tiles int")
    (tmp_path / "in").mkdir()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", st.STATE_STORE)

    def run(part, rows):
        spark.createDataFrame([(1, t, ts) for t, ts in rows], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        out = st.ready_blocks_stream(stream, needs, "10 minutes", 60)
        q = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        return [r.ready_ts for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect()]

    try:
        assert run(1, [(0, at(0, 0)), (1, at(0, 8))]) == []
        assert run(2, [(2, at(0, 5)), (1, at(0, 9))]) == [at(0, 8)]
        assert run(3, [(2, at(0, 9)), (0, at(0, 9))]) == [at(0, 8)]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def folded_batches(rows, size, wait_s):
    """Batches of one key's rows by a plain loop."""
    out, rows = [], sorted(rows)
    while rows:
        inside = [r for r in rows[:size] if (r[0] - rows[0][0]).total_seconds() < wait_s]
        out.append((len(inside), inside[0][0], inside[-1][0]))
        rows = rows[len(inside) :]
    return out


def test_micro_batches_stream(spark, tmp_path):
    """By size or wait, over several runs, as a loop over all rows makes them; a last message far later settles all before it."""
    random.seed(3)
    rows = [(datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=random.choice((1, 5, 40)) * k + random.randint(0, 30)), k) for k in range(60)]
    far = [(datetime.datetime(2024, 1, 3), 1000)], [(datetime.datetime(2024, 1, 9), 1001)]
    schema = "stage string, scene bigint, ts timestamp, event_id bigint"
    (tmp_path / "in").mkdir()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", st.STATE_STORE)
    try:
        for k, part in enumerate((sorted(rows)[:35], sorted(rows)[35:], *far)):
            spark.createDataFrame([("s", 1, *r) for r in part], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
            out = st.micro_batches_stream(stream, 4, 60_000)
            q = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
            q.awaitTermination()
        got = [(r.n, r.first_ts, r.last_ts) for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/out").orderBy("batch").collect()]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert got[: len(folded_batches(rows, 4, 60))] == folded_batches(rows, 4, 60)


def test_blocks_and_tiles_meet_without_a_broadcast(spark, sf_dir):
    """Blocks grow with scenes, whatever their tables' sizes are taken for."""
    from geoloom.plans.registry import QUERIES

    for name in ("jn12_block_tiles", "wn8_stream_overlap", "st13_streaming_accepted"):
        assert "BroadcastHashJoin" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_dissolving_by_bands(spark):
    """Boxes and gaps across the borders of bands of rows, above and below 0, as without bands."""
    rng = random.Random(3)
    boxes = [(s, r, r + rng.randint(1, 9), c, c + rng.randint(1, 9)) for s in range(3) for r, c in ((rng.randint(-140, 140), rng.randint(-20, 20)) for _ in range(150))]
    df = spark.createDataFrame(boxes, "scene bigint, r0 bigint, r1 bigint, c0 bigint, c1 bigint")
    plain = df.select("scene", F.explode(F.sequence("r0", F.col("r1") - 1)).alias("row"), "c0", "c1")
    for close in (0, 1):
        got = PG.of_bands(PG.dissolved(PG.banded(df, ["scene"], 2 * close), ["scene", "band"], close)).select("scene", "row", "c0", "c1")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, PG.dissolved(plain, ["scene"], close).select("scene", "row", "c0", "c1").collect()))


def test_boxes_by_bands_of_few_spans(spark):
    """Areas and objects of boxes, taken some spans at a time: bands of more spans than that, bands that end between batches, gaps across bands."""
    rng = random.Random(5)
    boxes = [(s, r, r + rng.choice((1, 3, 9, 300)), c, c + rng.randint(0, 9)) for s in (None, 1, 2, 3) for r, c in ((rng.randint(-140, 140), rng.randint(-30, 30)) for _ in range(20 * (s or 4) ** 2))]
    df = spark.createDataFrame(boxes, "scene bigint, r0 bigint, r1 bigint, c0 bigint, c1 bigint")
    plain = df.filter("c1 > c0").select("scene", F.explode(F.sequence("r0", F.col("r1") - 1)).alias("row"), "c0", "c1")
    n = F.sum(F.col("c1") - F.col("c0"))
    sums = lambda spans: {r[0]: r[1] for r in spans.groupBy("scene").agg(n).collect()}
    parts = sums(plain)
    for close in (0, 1, 2):
        closed = PG.dissolved(plain, ["scene"], close)
        areas = (sums(PG.dissolved(plain, ["scene"])), sums(closed), parts)
        objects = sorted(map(repr, PG.span_objects(closed, ["scene"], 12).collect()))
        for most in (40, 3000, PG.SPANS):
            assert {r.scene: r[1:] for r in PG.box_areas(df, ["scene"], close, most).collect()} == {s: tuple(a[s] for a in areas) for s in parts}
            assert sorted(map(repr, PG.box_objects(df, ["scene"], close, 12, most).collect())) == objects


def test_a_band_of_many_boxes_is_held_as_what_they_cover(spark):
    """Boxes upon boxes in one band: what a task takes at a time does not grow with them."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"scene": [7] * 5000, "band": [0] * 5000, "r0": [0] * 5000, "r1": [100] * 5000, "c0": [k % 50 for k in range(5000)], "c1": [k % 50 + 9 for k in range(5000)]})
    told = list(PG._whole_bands(iter([batch] * 20), ["scene"], 0, 1000))
    assert [(sum(rows.column("pixels").to_pylist()), list(first)) for rows, _, first in told] == [(20 * 5000 * 900, [0])]
    assert len(told[0][0]) < 1000


def test_merging_spans_holds_no_table_of_runs(spark):
    """Runs come from windows, which hold one row of pixels; an aggregate holds a task's runs in memory, which Spark can't spill while they are read."""
    spans = spark.createDataFrame([(1, 1, 1, 2)], "scene bigint, row bigint, c0 bigint, c1 bigint")
    assert "Aggregate" not in PG.dissolved(spans, ["scene"], 1)._jdf.queryExecution().executedPlan().toString()


def test_parts_across_bands(spark):
    """A snake that crosses the border of two bands back and forth is one part; one beside it is another."""
    snake = [(1, r, 4 * k, 4 * k + 1) for k in range(6) for r in range(120, 137)] + [(1, 136 if k % 2 else 120, 4 * k, 4 * k + 5) for k in range(5)]
    rows = snake + [(1, r, 40, 41) for r in range(100, 300)] + [(1, -129, 0, 2), (1, -128, 1, 3), (2, 127, 0, 1), (2, 128, 1, 2)]
    spans = PG.merged_spans(spark.createDataFrame(rows, "scene bigint, row bigint, c0 bigint, c1 bigint"), ["scene"])
    got = {(r.scene, r.object.row, r.object.c0): (r.pixels, r.row0, r.row1) for r in PG.span_objects(spans, ["scene"]).collect()}
    assert got == {(1, 120, 0): (6 * 17 + 15, 120, 136), (1, 100, 40): (200, 100, 299), (1, -129, 0): (4, -129, -128), (2, 127, 0): (1, 127, 127), (2, 128, 1): (1, 128, 128)}


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_outlines_are_dealt_out_once(spark, sf_dir):
    """Rows of pixels are cut where an outline's edges are: none is shuffled."""
    from geoloom.plans import tiles
    from geoloom.plans.views import Tables

    edges = tiles.edges_of(Tables(spark, sf_dir))
    before = _shuffles(edges)
    for spans in (PG.filled_spans, PG.touched_spans):
        assert _shuffles(tiles.told_pixels(spans(edges, ["scene", "gid"], 4))) == before


def test_many_entries_of_one_folder(spark):
    """Images below a folder are looked up once, however often it is listed; the first entry has them."""
    images = spark.createDataFrame([(k, f"a/b/{k}.tif") for k in range(30)], "image bigint, key string")
    report = spark.createDataFrame([(s, "b", None, None, "a/b", "folder_expanded") for s in range(5, 45)], "seq bigint, entry string, image bigint, score double, folder string, decision string")
    got = sm.matched_images(report, images)
    assert {(r.image, r.seq) for r in got.collect()} == {(k, 5) for k in range(30)}


def test_many_small_arrays(spark):
    """Arrays of several shapes, orders and types come back in place; a thousand small ones leave in a few frames."""
    import io

    import numpy as np

    arrays = [np.arange(6, dtype=t).reshape(shape, order=order) for t in ("uint8", "float32", "int16") for shape in ((1, 6), (2, 3)) for order in "CF"]
    rows = []
    for k, a in enumerate(arrays * 4):
        f = io.BytesIO()
        np.save(f, a)
        rows.append((str(k), bytearray(f.getvalue())))
    got = {(r.key, r.y, r.x): r.prob for r in rd.probability_pixels(spark.createDataFrame(rows, "key string, content binary")).collect()}
    want = {(str(k), y, x): float(np.float32(a[y, x]) / np.float32(255)) if a.dtype == np.uint8 else float(a[y, x]) for k, a in enumerate(arrays * 4) for y in range(a.shape[0]) for x in range(a.shape[1])}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_a_long_wait_is_settled_in_one_go():
    """Rows that a key holds are gone through once, not copied for each batch that leaves."""
    import time

    class State:
        def __init__(self, rows=()):
            self.rows = list(rows)

        get, exists, clear = (lambda self: self.rows), (lambda self: False), (lambda self: None)
        put = update = lambda self, x: None

    class Handle:
        listTimers = lambda self: []
        registerTimer = lambda self, t: None

    begin = datetime.datetime(2024, 1, 1)
    b = st.Batches(8, 14_400_000)
    b.handle, b.made = Handle(), State()
    b.rows = State((begin + datetime.timedelta(seconds=k), k) for k in range(200_000))
    at = time.process_time()
    (out,) = b._settle(("s", 1), 1 << 50)
    assert len(out) == 25_000 and set(out["n"]) == {8}
    assert time.process_time() - at < 8


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_join_and_names_are_not_broadcast(spark):
    """Rows that become several are dealt out: estimates of size, by which small files were broadcast, know nothing of it."""
    from geoloom.operators.ranked_join import ranked_rule_join

    left = spark.createDataFrame([(1, "A", "x"), (2, "b", None), (3, "c", "z")], "id long, a string, b string")
    right = spark.createDataFrame([(10, "a", "x"), (11, "a", "x"), (12, "b", None), (13, None, "y")], "image long, a string, b string")
    rules = [("exact", left["a"], right["a"]), ("other", left["b"], right["b"])]
    ranked = ranked_rule_join(left, right, "id", rules, [F.col("image")], ["image"])
    assert "Broadcast" not in plan_of(ranked)
    assert sorted(tuple(r) for r in ranked.select("id", "image", "rule", "n_matches").collect()) == [(1, 10, "other", 2), (2, 12, "exact", 1), (3, None, None, None)]
    scenes = spark.createDataFrame([(1, "a/B.tif"), (2, "c/b.tif")], "scene long, key string")
    features = spark.createDataFrame([(1, "x/b.tif"), (2, "B"), (3, "z")], "id long, name string")
    named = sm.match_names(features, "id", "name", scenes, "scene", "key")
    assert "Broadcast" not in plan_of(named)
    assert {r.id: r.scene for r in named.collect()} == {1: 1, 2: 1}


def test_short_names_find_each_other_by_what_is_left_of_them(spark):
    """All pairs by difflib; likeness is measured once for a pair, not before repeated pairs are dropped."""
    random.seed(8)
    words = sorted({"".join(random.choices("ab1", k=random.randint(2, 19))) for _ in range(90)} | {"aaaaaaaaaaaa", "aaaaaaaaaaab", "abaaaaaaaaaaaa"})
    entries = spark.createDataFrame(list(enumerate(words[::2])), "seq bigint, needle string")
    images = spark.createDataFrame(list(enumerate(words)), "image bigint, name string")
    found = sm.like_candidates(entries, images, 0.85)
    assert plan_of(found).count("ArrowEvalPython") == 1
    got = {(x.seq, x.image): x.score for x in found.collect()}
    ratio = {(i, k): round(difflib.SequenceMatcher(None, a, b).ratio(), 6) for i, a in enumerate(words[::2]) for k, b in enumerate(words)}
    assert got == {p: s for p, s in ratio.items() if s >= 0.85}


def test_blur_shuffles_pixels_once(spark):
    """Images of more rows than a band, of one column and of one pixel, with pixels that nothing saw, against a plain loop."""
    random.seed(25)
    sizes = {1: (3, 150), 2: (1, 70), 3: (1, 1), 4: (9, 65)}
    seen = {(s, y, x): random.randint(0, 255) for s, (w, h) in sizes.items() for y in range(h) for x in range(w) if s == 3 or random.random() < 0.6}
    df = spark.createDataFrame([(s, y, x, v, *sizes[s]) for (s, y, x), v in seen.items()], "scene bigint, y bigint, x bigint, value int, w bigint, h bigint")
    blur = R.blurred(df, F.col("w"), F.col("h"))
    assert plan_of(blur).count("Exchange") == 1
    clip = lambda k, size: max(0, min(size - 1, k))
    around = {(s, y, x): [seen.get((s, clip(y + dy, sizes[s][1]), clip(x + dx, sizes[s][0]))) for dy in (-1, 0, 1) for dx in (-1, 0, 1)] for s, y, x in seen}
    got = {(r.scene, r.y, r.x): r.blur for r in blur.collect()}
    assert got == {k: pytest.approx(sum(v for v in a if v is not None) / 9) for k, a in around.items()}


def test_best_metric_name_deals_runs_out_once(spark, sf_dir):
    from geoloom.plans.registry import QUERIES

    assert plan_of(QUERIES["wn7_best_metric_name"](spark, sf_dir)).count("Exchange") == 1


_BOX_ROWS = "scene bigint, {} bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint"


def _boxes(seed):
    rng = random.Random(seed)
    sides = [(rng.randint(-150, 150), rng.randint(-150, 150), rng.choice([0, 1, 7, 40, 60, 300]), rng.choice([0, 1, 7, 40, 60, 300])) for _ in range(250)]
    return [(k % 2, k, x, y, x + w, y + h) for k, (x, y, w, h) in enumerate(sides)]


@pytest.mark.parametrize("threshold", [0.0, 0.1, 1 / 3, 0.5, 0.9])
def test_iou_pairs_by_centres(spark, threshold):
    p, g = _boxes(1), _boxes(2) + [(s, 1000 + k, x0, y0, x1 + k % 3, y1) for s, k, x0, y0, x1, y1 in _boxes(1)]
    want = set()
    for s, k, ax0, ay0, ax1, ay1 in p:
        for t, m, bx0, by0, bx1, by1 in g:
            wide, high = min(ax1, bx1) - max(ax0, bx0), min(ay1, by1) - max(ay0, by0)
            if s == t and wide > 0 and high > 0 and (v := wide * high / ((ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - wide * high)) > threshold:
                want.add((s, k, m, v))
    got = ob.iou_pairs(spark.createDataFrame(p, _BOX_ROWS.format("pid")), spark.createDataFrame(g, _BOX_ROWS.format("gid")), threshold).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_iou_pairs_code_is_compiled(spark):
    """Methods of more than 8,000 bytes of byte code are never compiled by the JVM, and took tens of microseconds a row."""
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [spark.createDataFrame(_boxes(1), _BOX_ROWS.format(i)) for i in ("pid", "gid")]
        made = ob.iou_pairs(*rows, 0.5).withColumn("iou", F.round("iou", 9))
        code = spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
