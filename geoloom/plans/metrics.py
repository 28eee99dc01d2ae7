"""Pixel and object metrics, threshold sweeps, losses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from .registry import query
from .views import Tables

HALF = 128
THRESHOLDS = (32, 64, 96, 128, 160, 192, 224)

_COUNTS = """count(*) FILTER (truth <> 255 AND prob8 >= {t} AND truth = 1) AS tp, count(*) FILTER (truth <> 255 AND prob8 >= {t} AND truth <> 1) AS fp,
    count(*) FILTER (truth <> 255 AND prob8 < {t} AND truth = 1) AS fn, count(*) FILTER (truth <> 255 AND prob8 < {t} AND truth <> 1) AS tn"""


def counts(df: DataFrame, *keys: str, threshold=HALF) -> DataFrame:
    pred = (F.col("prob8") >= threshold).cast("int")
    return df.groupBy(*keys).agg(*(c.alias(k) for k, c in M.confusion(pred, F.col("truth")).items()))


@query("ag1_confusion_counts", f"SELECT scene, {_COUNTS.format(t=HALF)} FROM @observations GROUP BY 1")
def confusion_counts(t: Tables) -> DataFrame:
    return counts(t.observations, "scene")


@query(
    "ag2_pixel_scores",
    f"""SELECT scene, round(CASE WHEN tp + fp + fn = 0 THEN 1.0 WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 9) AS "precision",
    round(CASE WHEN tp + fp + fn = 0 THEN 1.0 WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 9) AS recall,
    round(CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 9) AS f1, round(CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE tp / (tp + fp + fn) END, 9) AS iou
    FROM (SELECT scene, {_COUNTS.format(t=HALF)} FROM @observations GROUP BY 1) c""",
)
def pixel_scores(t: Tables) -> DataFrame:
    scores = M.pixel_scores(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts(t.observations, "scene").select("scene", *(F.round(c, 9).alias(k) for k, c in scores.items()))


@query("ag3_merged_counts", f"SELECT {_COUNTS.format(t=HALF)} FROM @observations")
def merged_counts(t: Tables) -> DataFrame:
    """Totals as the sum of partial counts by scene."""
    return counts(t.observations, "scene").agg(*(F.sum(k).alias(k) for k in ("tp", "fp", "fn", "tn")))


_SWEEP = f"sweep AS (SELECT t, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, tp, fp, fn FROM (SELECT t, {_COUNTS.format(t='t')} FROM @observations, (SELECT unnest({list(THRESHOLDS)}) AS t) u GROUP BY 1) c)"


def sweep(df: DataFrame) -> DataFrame:
    """Scores at all thresholds from one pass: pixels are counted by value, then the few values by threshold."""
    by_value = df.filter(F.col("truth") != M.IGNORE).groupBy("prob8").agg(F.count_if(F.col("truth") == 1).alias("p"), F.count_if(F.col("truth") != 1).alias("n"))
    each = by_value.withColumn("t", F.explode(F.array(*map(F.lit, THRESHOLDS))))
    on = F.col("prob8") >= F.col("t")
    total = each.groupBy("t").agg(F.sum(F.when(on, F.col("p")).otherwise(0)).alias("tp"), F.sum(F.when(on, F.col("n")).otherwise(0)).alias("fp"), F.sum(F.when(~on, F.col("p")).otherwise(0)).alias("fn"))
    return total.withColumn("f1", F.round(M.pixel_scores(F.col("tp"), F.col("fp"), F.col("fn"))["f1"], 9))


@query("ag4_threshold_sweep", f"WITH {_SWEEP} SELECT t, tp, fp, fn, f1 FROM sweep")
def threshold_sweep(t: Tables) -> DataFrame:
    return sweep(t.observations)


@query("ag4_best_threshold", f"WITH {_SWEEP} SELECT t, f1 FROM sweep ORDER BY f1 DESC, t LIMIT 1")
def best_threshold(t: Tables) -> DataFrame:
    return sweep(t.observations).orderBy(F.desc("f1"), "t").select("t", "f1").limit(1)


@query("ag7_weighted_loss", "SELECT scene, round(sum(prob8 * weight) / sum(weight), 9) AS loss FROM @observations GROUP BY 1")
def weighted_loss(t: Tables) -> DataFrame:
    return t.observations.groupBy("scene").agg(F.round(F.sum(F.col("prob8") * F.col("weight")) / F.sum("weight"), 9).alias("loss"))


_LOGIT = "((prob8 - 127.5) / 32.0)"
_P = f"(1.0 / (1.0 + exp(-{_LOGIT})))"


def _logit():
    return (F.col("prob8") - F.lit(127.5)) / F.lit(32.0)


@query(
    "loss_bce_focal",
    f"""SELECT scene, round(avg(greatest({_LOGIT}, 0) - {_LOGIT} * truth + ln(1 + exp(-abs({_LOGIT})))), 6) AS bce,
    round(avg((1 - truth) * {_LOGIT} + (1 + 2 * truth) * (ln(1 + exp(-abs({_LOGIT}))) + greatest(-{_LOGIT}, 0))), 6) AS bce_weighted,
    round(avg((0.25 * truth + 0.75 * (1 - truth)) * pow(1 - ({_P} * truth + (1 - {_P}) * (1 - truth)), 2) * ((1 - truth) * {_LOGIT} + ln(1 + exp(-abs({_LOGIT}))) + greatest(-{_LOGIT}, 0))), 6) AS focal
    FROM @observations WHERE truth <> 255 GROUP BY 1""",
)
def loss_bce_focal(t: Tables) -> DataFrame:
    x, y = _logit(), F.col("truth")
    made = {"bce": M.bce(x, y), "bce_weighted": M.bce(x, y, 3.0), "focal": M.focal(x, y, alpha=0.25)}
    return t.observations.filter("truth <> 255").groupBy("scene").agg(*(F.round(F.avg(c), 6).alias(k) for k, c in made.items()))


@query(
    "loss_dice_tversky",
    f"""SELECT scene, round(1 - (2 * sum({_P} * truth) + 1) / (sum({_P}) + sum(truth) + 1), 6) AS dice,
    round(1 - (sum({_P} * truth) + 1) / (sum({_P} * truth) + 0.3 * sum({_P} * (1 - truth)) + 0.7 * sum((1 - {_P}) * truth) + 1), 6) AS tversky
    FROM @observations WHERE truth <> 255 GROUP BY 1""",
)
def loss_dice_tversky(t: Tables) -> DataFrame:
    p, y = M.sigmoid(_logit()), F.col("truth")
    return t.observations.filter("truth <> 255").groupBy("scene").agg(F.round(M.dice_loss(p, y, 1.0), 6).alias("dice"), F.round(M.tversky_loss(p, y, 0.3, 0.7, 1.0), 6).alias("tversky"))


@query(
    "loss_combined",
    f"""SELECT scene, round(0.5 * avg(greatest({_LOGIT}, 0) - {_LOGIT} * truth + ln(1 + exp(-abs({_LOGIT})))) + 0.5 * (1 - (2 * sum({_P} * truth) + 1) / (sum({_P}) + sum(truth) + 1)), 6) AS bce_dice
    FROM @observations WHERE truth <> 255 GROUP BY 1""",
)
def loss_combined(t: Tables) -> DataFrame:
    x, y = _logit(), F.col("truth")
    return t.observations.filter("truth <> 255").groupBy("scene").agg(F.round(0.5 * F.avg(M.bce(x, y)) + 0.5 * M.dice_loss(M.sigmoid(x), y, 1.0), 6).alias("bce_dice"))


_PARTS = f"""parts AS (SELECT scene, avg(greatest({_LOGIT}, 0) - {_LOGIT} * truth + ln(1 + exp(-abs({_LOGIT})))) AS b,
    avg(pow(1 - ({_P} * truth + (1 - {_P}) * (1 - truth)), 2) * ((1 - truth) * {_LOGIT} + ln(1 + exp(-abs({_LOGIT}))) + greatest(-{_LOGIT}, 0))) AS f,
    1 - (2 * sum({_P} * truth) + 1e-7) / (sum({_P}) + sum(truth) + 1e-7) AS d, 1 - (sum({_P} * truth) + 1e-7) / (sum({_P} * truth) + 0.5 * sum({_P} * (1 - truth)) + 0.5 * sum((1 - {_P}) * truth) + 1e-7) AS t
    FROM @observations WHERE truth <> 255 GROUP BY 1)"""
_SUMS = {"bce": "b", "dice": "d", "focal": "f", "tversky": "t", "bce_dice": "b + d", "focal_dice": "f + d", "bce_tversky": "b + t", "focal_tversky": "f + t", "bce_focal_dice": "b + f + d"}


@query("loss_by_name", f"WITH {_PARTS} SELECT scene, " + ", ".join(f"round({v}, 6) AS {k}" for k, v in _SUMS.items()) + " FROM parts")
def loss_by_name(t: Tables) -> DataFrame:
    """All nine losses, with their usual parameters."""
    made = [F.round(M.segmentation_loss(k, _logit(), F.col("truth")), 6).alias(k) for k in M.LOSSES]
    return t.observations.filter("truth <> 255").groupBy("scene").agg(*made)


@query("loss_lr_schedule", "SELECT c_custkey % 100 AS epoch, round(0.00001 + 0.5 * (0.001 - 0.00001) * (1 + cos(pi() * (c_custkey % 100) / 100)), 12) AS cosine, round(0.001 * pow(0.1, floor((c_custkey % 100) / 30)), 12) AS step FROM @customer GROUP BY 1, 2, 3")
def lr_schedule(t: Tables) -> DataFrame:
    e = F.col("epoch")
    cosine = F.lit(0.00001) + F.lit(0.5) * (F.lit(0.001) - F.lit(0.00001)) * (1 + F.cos(F.pi() * e / 100))
    return t.customer.select((F.col("c_custkey") % 100).alias("epoch")).distinct().select("epoch", F.round(cosine, 12).alias("cosine"), F.round(F.lit(0.001) * F.pow(F.lit(0.1), F.floor(e / 30)), 12).alias("step"))


@query("fn17_safe_divide", "SELECT scene, gid, CASE WHEN gid % 3 = 0 THEN 0.0 ELSE round(x0 / (gid % 3), 9) END AS q FROM @annotations")
def safe_divide(t: Tables) -> DataFrame:
    return t.annotations.select("scene", "gid", F.round(M.ratio(F.col("x0"), F.col("gid") % 3), 9).alias("q"))


@query("fn18_sigmoid_softmax", f"SELECT obs, round({_P}, 9) AS p, round(exp(prob8 / 255.0) / (exp(prob8 / 255.0) + exp(weight / 4.0)), 9) AS soft FROM @observations")
def sigmoid_softmax(t: Tables) -> DataFrame:
    a, b = F.exp(F.col("prob8") / F.lit(255.0)), F.exp(F.col("weight") / F.lit(4.0))
    return t.observations.select("obs", F.round(M.sigmoid(_logit()), 9).alias("p"), F.round(a / (a + b), 9).alias("soft"))


@query("fn19_threshold", "SELECT obs, prob8 >= 128 AS on_ FROM @observations")
def threshold(t: Tables) -> DataFrame:
    return t.observations.select("obs", (F.col("prob8") >= HALF).alias("on_"))


@query(
    "fn20_standard_f1",
    """SELECT run_id, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 9) AS f1, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END / (2 - CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END), 9) AS iou,
    abs(pixel_f1 - CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) <= greatest(abs(pixel_f1), abs(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END)) * 0.001 AS consistent
    FROM (SELECT run_id, pixel_f1, (run_id % 101) / 100.0 AS p, (run_id % 97) / 96.0 AS r FROM @runs) q""",
)
def standard_f1(t: Tables) -> DataFrame:
    """F1 and IoU recomputed from precision and recall, and whether the reported F1 agrees."""
    f1 = M.f1_of((F.col("run_id") % 101) / F.lit(100.0), (F.col("run_id") % 97) / F.lit(96.0))
    return t.runs.select("run_id", F.round(f1, 9).alias("f1"), F.round(M.iou_of(f1), 9).alias("iou"), M.is_close(F.col("pixel_f1"), f1).alias("consistent"))


@query("rg13_thresholds", "SELECT scene, unnest(list_sort(list_distinct([0.5, least(1.0, greatest(0.0, (scene % 30 - 5) / 20.0)), least(1.0, greatest(0.0, (scene % 7) / 10.0))]))) AS threshold FROM @scenes")
def thresholds(t: Tables) -> DataFrame:
    """A list of thresholds: clamped to 0..1, each once, the configured one added."""
    given = F.array(F.lit(0.5), (F.col("scene") % 30 - 5) / F.lit(20.0), (F.col("scene") % 7) / F.lit(10.0))
    clamped = F.transform(given, lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))
    return t.scenes.select("scene", F.explode(F.array_sort(F.array_distinct(clamped))).alias("threshold"))


_EPOCHS = "epochs AS (SELECT l_suppkey AS run, l_orderkey AS epoch, max((l_orderkey * 7 + l_suppkey * 13) % 1000) AS f1, sum(CAST(l_quantity AS BIGINT)) AS secs FROM @lineitem GROUP BY 1, 2)"


def epochs(t: Tables) -> DataFrame:
    score = (F.col("l_orderkey") * 7 + F.col("l_suppkey") * 13) % 1000
    return t.lineitem.groupBy(F.col("l_suppkey").alias("run"), F.col("l_orderkey").alias("epoch")).agg(F.max(score).alias("f1"), F.sum(F.col("l_quantity").cast("bigint")).alias("secs"))


@query("wn5_best_epoch", f"WITH {_EPOCHS} SELECT run, arg_max(epoch, f1 * 100000000 - epoch) AS best_epoch, max(f1) AS best_f1, arg_max(f1, epoch) AS last_f1, max(epoch) AS last_epoch FROM epochs GROUP BY 1")
def best_epoch(t: Tables) -> DataFrame:
    """The first epoch with the best score, and the last one."""
    best = F.max(F.struct("f1", (-F.col("epoch")).alias("e")))
    rows = epochs(t).groupBy("run").agg(best.alias("b"), F.max(F.struct("epoch", "f1")).alias("l"))
    return rows.select("run", (-F.col("b.e")).alias("best_epoch"), F.col("b.f1").alias("best_f1"), F.col("l.f1").alias("last_f1"), F.col("l.epoch").alias("last_epoch"))


@query(
    "mt9_early_stopping",
    f"""WITH {_EPOCHS}, a AS (SELECT *, max(f1) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, row_number() OVER (PARTITION BY run ORDER BY epoch) AS n FROM epochs),
    b AS (SELECT *, max(CASE WHEN before IS NULL OR f1 > before THEN n END) OVER (PARTITION BY run ORDER BY epoch) AS improved FROM a)
    SELECT run, min(CASE WHEN n - improved >= 5 THEN epoch END) AS stop_epoch, max(n) AS epochs FROM b GROUP BY 1""",
)
def early_stopping(t: Tables) -> DataFrame:
    """The first epoch at which no strict improvement has been seen for five epochs."""
    w = Window.partitionBy("run").orderBy("epoch")
    rows = epochs(t).withColumns({"before": F.max("f1").over(w.rowsBetween(Window.unboundedPreceding, -1)), "n": F.row_number().over(w)})
    better = F.when(F.col("before").isNull() | (F.col("f1") > F.col("before")), F.col("n"))
    rows = rows.withColumn("improved", F.max(better).over(w))
    return rows.groupBy("run").agg(F.min(F.when(F.col("n") - F.col("improved") >= 5, F.col("epoch"))).alias("stop_epoch"), F.max("n").alias("epochs"))


@query("ag26_training_summary", f"WITH {_EPOCHS} SELECT run, round(avg(secs), 9) AS mean_secs, count(*) AS epochs, arg_max(f1, epoch) - min(f1) AS gain FROM epochs GROUP BY 1")
def training_summary(t: Tables) -> DataFrame:
    return epochs(t).groupBy("run").agg(F.round(F.avg("secs"), 9).alias("mean_secs"), F.count(F.lit(1)).alias("epochs"), (F.max_by("f1", "epoch") - F.min("f1")).alias("gain"))


@query("ag27_last_samples", "SELECT stage, count(*) AS n, sum(bytes) AS bytes FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, event_id DESC) AS p FROM @messages) q WHERE p <= 240 GROUP BY 1")
def last_samples(t: Tables) -> DataFrame:
    """Resource samples: the latest 240 of each series."""
    w = Window.partitionBy("stage").orderBy(F.desc("ts"), F.desc("event_id"))
    return t.messages.withColumn("p", F.row_number().over(w)).filter("p <= 240").groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
