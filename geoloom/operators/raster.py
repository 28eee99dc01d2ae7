"""Pixels as rows: stitching, validity, components, dissolving boxes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import Held
from .polygons import span_roots


def stitched(observations: DataFrame, prob: Column, weight: Column | None = None) -> DataFrame:
    """(scene, y, x, prob, weight) of overlapping tiles: the weighted mean of what they saw; weight 1 if none is given."""
    w = F.lit(1) if weight is None else weight
    total = F.sum(w)
    return observations.groupBy("scene", "y", "x").agg((F.sum(prob * w) / F.greatest(total, F.lit(1e-6))).alias("prob"), total.alias("weight"))


def hard_inserted(observations: DataFrame, order: list[str]) -> DataFrame:
    """(scene, y, x, prob8): the last tile in order wins."""
    return observations.groupBy("scene", "y", "x").agg(F.max_by("prob8", F.struct(*order)).alias("prob8"))


def percentile_stretch(rows: DataFrame, key: str, value: str, least: int = 16) -> DataFrame:
    """rows with `low` and `high`: the 2nd and 98th percentile of values other than 0; null below `least` values; high is at least low + 1."""
    nonzero = F.when(F.col(value) != 0, F.col(value))
    stats = rows.groupBy(key).agg(F.count(nonzero).alias("n"), F.percentile(nonzero, F.lit(0.02)).alias("p2"), F.percentile(nonzero, F.lit(0.98)).alias("p98"))
    enough = F.col("n") >= least
    high = F.when(F.col("p98") <= F.col("p2"), F.col("p2") + 1).otherwise(F.col("p98"))
    return rows.join(stats.select(key, F.when(enough, F.col("p2")).alias("low"), F.when(enough, high).alias("high")), key)


def label_components(pixels: DataFrame) -> DataFrame:
    """pixels (scene, y, x) with `label` (label_y, label_x): connected by edges, named by the smallest (y, x) of each component.

    Neighbouring pixels of a row are one span; spans of neighbouring rows that share a column are linked, and the links' components name
    the pixels. No task has to hold a scene, or a component.
    """
    rows = pixels.select("scene", "y", "x").distinct()
    w = Window.partitionBy("scene", "y").orderBy("x")
    runs = rows.withColumn("run", F.col("x") - F.row_number().over(w))
    held = Held(pixels.sparkSession, "spans")
    runs = held.put(runs.withColumn("c0", F.min("x").over(Window.partitionBy("scene", "y", "run"))).drop("run"))
    spans = runs.groupBy("scene", F.col("y").alias("row"), "c0").agg((F.max("x") + 1).alias("c1"))
    named = span_roots(spans, ["scene"]).select("scene", F.col("row").alias("y"), "c0", F.struct(F.col("object.row").alias("label_y"), F.col("object.c0").alias("label_x")).alias("label"))
    return runs.join(named, ["scene", "y", "c0"]).select("scene", "y", "x", "label")


def eroded(mask: DataFrame) -> DataFrame:
    """Pixels (scene, y, x) of a mask whose eight neighbours are in it too."""
    offsets = F.explode(F.expr("flatten(transform(sequence(-1, 1), dy -> transform(sequence(-1, 1), dx -> struct(dy, dx))))"))
    around = mask.select("scene", "y", "x").distinct().select("scene", "y", "x", offsets.alias("o"))
    return around.groupBy("scene", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x")).count().filter("count = 9").drop("count")


def dilated(mask: DataFrame, radius: int = 1) -> DataFrame:
    """All pixels at most radius away from the mask along both axes."""
    offsets = F.explode(F.expr(f"flatten(transform(sequence(-{radius}, {radius}), dy -> transform(sequence(-{radius}, {radius}), dx -> struct(dy, dx))))"))
    around = mask.select("scene", "y", "x").distinct().select("scene", "y", "x", offsets.alias("o"))
    return around.select("scene", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x")).distinct()


#: Rows of an image that one task blurs, and more than any row has pixels.
BLUR_ROWS, BLUR_LINE = 64, 1 << 32


def blurred(pixels: DataFrame, w: Column, h: Column) -> DataFrame:
    """pixels (scene, y, x, value) of whole images, w wide and h high, with `blur`: the mean of the nine pixels around, where the image's edge goes on beyond it.

    A pixel at an edge stands for those beyond it too. Bands of BLUR_ROWS rows of an image are gone through in order, each with the rows next to it,
    and a window of three pixels slides along the rows above, at and below a pixel: only pixels are shuffled, once.
    """
    own = lambda c, size: F.filter(F.array(F.when(F.col(c) == 0, F.lit(-1).cast("bigint")), F.col(c).cast("bigint"), F.when(F.col(c) == size - 1, size.cast("bigint"))), lambda k: k.isNotNull())
    band = lambda k: F.floor(k / BLUR_ROWS).cast("bigint")
    inside = pixels.filter(F.col("scene").isNotNull() & F.col("y").between(0, h - 1) & F.col("x").between(0, w - 1))
    stands = inside.withColumns({"of_y": own("y", h), "of_x": own("x", w), "height": h}).withColumn("of_y", F.explode("of_y")).withColumn("of_x", F.explode("of_x"))
    seen = F.sequence(band(F.greatest(F.col("of_y") - 1, F.lit(0))), band(F.least(F.col("of_y") + 1, F.col("height") - 1)))
    rows = stands.withColumn("band", F.explode(seen)).withColumn("at", F.col("of_y") * BLUR_LINE + F.col("of_x"))
    near = lambda k: F.sum("value").over(Window.partitionBy("scene", "band").orderBy("at").rangeBetween(k * BLUR_LINE - 1, k * BLUR_LINE + 1))
    told = rows.withColumns({f"near_{k + 1}": near(k) for k in (-1, 0, 1)}).filter((F.col("of_y") == F.col("y")) & (F.col("of_x") == F.col("x")) & (F.col("band") == band(F.col("y"))))
    parts = [F.col(f"near_{k}") for k in range(3)]
    total = F.when(F.coalesce(*parts).isNotNull(), sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(0)))
    return told.withColumn("blur", total / 9.0).select(*pixels.columns, "blur")


def unit_draw(seed: int, *parts: Column | str) -> Column:
    """A number from 0 up to 1 for each row's parts, the same whenever it is drawn."""
    told = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts)))
    return F.conv(F.substring(told, 1, 8), 16, 10).cast("double") / float(1 << 32)


def noise(seed: int, *parts: Column | str, deviation: float = 0.02) -> Column:
    """Normally distributed, from two draws by the method of Box and Muller."""
    u, v = (unit_draw(seed + k, *parts) for k in (0, 1))
    return F.lit(deviation) * F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * F.pi() * v)


def cutouts(images: DataFrame, seed: int, share: float = 0.35, holes: int = 1) -> DataFrame:
    """(scene, hole, y0, x0, y1, x1) of images (scene, w, h): in this share of them so many holes, an eighth of the image along each side and 8 pixels at least."""
    drawn = images.filter(unit_draw(seed, "scene") < share).withColumn("hole", F.explode(F.sequence(F.lit(1), F.lit(holes))))
    sides = {c: F.greatest(F.lit(8), F.floor(F.col(s) / 8)) for c, s in (("y", "h"), ("x", "w"))}
    first = {c: F.floor(unit_draw(seed + k, "scene", "hole") * (F.greatest(F.lit(0), F.col(s) - sides[c]) + 1)) for k, (c, s) in enumerate((("y", "h"), ("x", "w")), 1)}
    return drawn.select("scene", "hole", *(first[c].alias(f"{c}0") for c in "yx"), *((first[c] + sides[c]).alias(f"{c}1") for c in "yx"))


def cut_out(pixels: DataFrame, holes: DataFrame, erase_mask: bool = True) -> DataFrame:
    """pixels (scene, y, x, value, truth) with value 0, and no truth if so asked, in an image's holes."""
    marked = holes.groupBy("scene").agg(F.collect_list(F.struct("y0", "x0", "y1", "x1")).alias("holes"))  # a few an image
    inside = F.coalesce(F.exists("holes", lambda h: (F.col("y") >= h["y0"]) & (F.col("y") < h["y1"]) & (F.col("x") >= h["x0"]) & (F.col("x") < h["x1"])), F.lit(False))
    told = pixels.join(marked, "scene", "left").withColumn("inside", inside)
    told = told.withColumn("value", F.when(F.col("inside"), 0).otherwise(F.col("value")))
    return (told.withColumn("truth", F.when(F.col("inside"), 0).otherwise(F.col("truth"))) if erase_mask else told).drop("holes")


def window_pixels(scenes: DataFrame, pixels: DataFrame, x0: Column, y0: Column, w: int, h: int) -> DataFrame:
    """(scene, y, x, value) of a window of each scene, places counted from its corner; what lies beyond the raster, or was not seen, is 0."""
    steps = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    want = scenes.select("scene", x0.alias("x0"), y0.alias("y0"), steps(h).alias("y")).select("scene", "x0", "y0", "y", steps(w).alias("x"))
    at = want.select("scene", "y", "x", (F.col("y0") + F.col("y")).alias("at_y"), (F.col("x0") + F.col("x")).alias("at_x"))
    seen = pixels.select("scene", F.col("y").alias("at_y"), F.col("x").alias("at_x"), "value")
    return at.join(seen, ["scene", "at_y", "at_x"], "left").select("scene", "y", "x", F.coalesce("value", F.lit(0)).alias("value"))


def seam_jumps(pixels: DataFrame, every: int) -> DataFrame:
    """(scene, seam, mean_jump, max_jump): absolute steps between columns seam - 1 and seam, at every so many columns."""
    left = F.lag("value").over(Window.partitionBy("scene", "y").orderBy("x"))
    before = F.lag("x").over(Window.partitionBy("scene", "y").orderBy("x"))
    steps = pixels.withColumns({"step": F.abs(F.col("value") - left), "before": before})
    at = steps.filter((F.col("x") % every == 0) & (F.col("x") > 0) & (F.col("before") == F.col("x") - 1))
    return at.groupBy("scene", F.col("x").alias("seam")).agg(F.avg("step").alias("mean_jump"), F.max("step").alias("max_jump"))


def scene_statistics(pixels: DataFrame, scenes: DataFrame, most: int = 1024) -> DataFrame:
    """(scene, low, high): percentiles 2 and 98 of the pixels (scene, y, x, value) that are not zero; 0 and 1 where there are under 16.

    A scene (scene, w, h) with a side above `most` pixels (64 at least) is read as an image of that size, by the nearest pixels.
    """
    scale = F.greatest(F.lit(1.0), F.greatest("w", "h") / F.lit(float(max(64, most))))

    def read(at: str, size: str) -> Column:
        # output pixel k reads pixel floor((k + 0.5) size / n): is there such a k for this pixel?
        n = F.greatest(F.lit(1.0), F.rint(F.col(size) / scale))
        return F.ceil(F.col(at) * n / F.col(size) - 0.5) < (F.col(at) + 1) * n / F.col(size) - 0.5

    rows = pixels.join(scenes.select("scene", "w", "h"), "scene").filter(read("x", "w") & read("y", "h"))
    value = F.when((F.col("value") != 0) & ~F.isnan(F.col("value").cast("double")), F.col("value"))
    told = rows.groupBy("scene").agg(F.count(value).alias("n"), F.percentile(value, F.lit(0.02)).alias("lo"), F.percentile(value, F.lit(0.98)).alias("hi"))
    low = F.when(F.col("n") < 16, 0.0).otherwise(F.col("lo"))
    high = F.when(F.col("n") < 16, 1.0).when(F.col("hi") <= F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi"))
    return told.select("scene", low.alias("low"), high.alias("high"))


#: Masks that are taken by themselves where they leave out a part of a window, in this order.
PARTIAL_MASKS = ("dataset_mask", "alpha", "nodata")


def valid_mask(pixels: DataFrame, window: list[str], mode: str = "auto") -> DataFrame:
    """(window, y, x, valid, source) of pixels with one boolean column for each mode; a mode's column is null where a window has no such mask.

    auto takes of each window the first of PARTIAL_MASKS that has some of its pixels but not all, else what is not zero in any band, and if
    everything is zero the window's own mask, or nothing (source `empty`) if it has none.
    """
    modes = (*PARTIAL_MASKS, "nonzero_any", "nonzero_all")
    if mode != "auto":
        if mode not in modes:
            raise ValueError(f"unknown mode {mode}")
        return pixels.select(*window, "y", "x", F.col(mode).alias("valid"), F.lit(mode).alias("source"))
    source = F.when(F.lit(False), "")
    for m in PARTIAL_MASKS:
        source = source.when(F.bool_or(m) & ~F.bool_and(m), m)
    source = source.when(F.bool_or("nonzero_any"), "nonzero_any").when(F.count("dataset_mask") > 0, "dataset_mask").otherwise("empty")
    told = pixels.join(pixels.groupBy(*window).agg(source.alias("source")), window)
    valid = F.coalesce(*(F.when(F.col("source") == m, F.col(m)) for m in modes), F.lit(False))
    return told.select(*window, "y", "x", valid.alias("valid"), "source")


def simplified(points: DataFrame, tolerance: float) -> DataFrame:
    """Douglas-Peucker: of each ring (ring, k, x, y) the points whose removal would move the line by more than tolerance."""

    def kept(xs: list[float], ys: list[float]) -> list[int]:
        stay, stack = {0, len(xs) - 1}, [(0, len(xs) - 1)]
        while stack:
            a, b = stack.pop()
            dx, dy = xs[b] - xs[a], ys[b] - ys[a]
            n = (dx * dx + dy * dy) ** 0.5
            best, far = None, tolerance
            for k in range(a + 1, b):
                ex, ey = xs[k] - xs[a], ys[k] - ys[a]
                d = abs(dx * ey - dy * ex) / n if n else (ex * ex + ey * ey) ** 0.5
                if d > far:
                    best, far = k, d
            if best is not None:
                stay.add(best)
                stack += [(a, best), (best, b)]
        return sorted(stay)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("line")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).tolist()
            flat = lists.flatten()
            xs, ys = (flat.field(c).to_numpy(zero_copy_only=False).tolist() for c in ("x", "y"))
            ring, stay = [], []
            for r, (a, b) in enumerate(zip(ends, ends[1:])):
                at = kept(xs[a:b], ys[a:b])
                ring += [r] * len(at)
                stay += [a + k for k in at]
            rings, points = batch.column("ring").take(pa.array(ring, pa.int64())), flat.take(pa.array(stay, pa.int64()))
            yield pa.RecordBatch.from_arrays([rings, *(points.field(c) for c in ("k", "x", "y"))], names=["ring", "k", "x", "y"])

    point = F.struct(F.col("k").isNull().alias("none"), "k", "x", "y")
    lines = points.groupBy("ring").agg(F.array_sort(F.collect_list(point)).alias("line"))
    return lines.mapInArrow(run, points.select("ring", "k", "x", "y").schema)
