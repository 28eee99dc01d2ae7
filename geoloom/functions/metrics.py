"""Segmentation metrics, probabilities and losses as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE = 255


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """part / whole, or `empty` where whole is 0."""
    return F.when(whole == 0, F.lit(empty)).otherwise(part.cast("double") / whole.cast("double"))


def confusion(pred: Column, truth: Column, ignore: int = IGNORE) -> dict[str, Column]:
    """Aggregates tp, fp, fn, tn over pixels whose truth is not the ignore label."""
    valid = truth != ignore
    on, real = pred == 1, truth == 1
    return {
        "tp": F.count_if(valid & on & real),
        "fp": F.count_if(valid & on & ~real),
        "fn": F.count_if(valid & ~on & real),
        "tn": F.count_if(valid & ~on & ~real),
    }


def pixel_scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall, F1 and IoU of pixels; all 1 where nothing is there and nothing was found."""
    nothing = tp + fp + fn == 0
    one = lambda c: F.when(nothing, F.lit(1.0)).otherwise(c)
    return {"precision": one(ratio(tp, tp + fp)), "recall": one(ratio(tp, tp + fn)), "f1": one(ratio(2 * tp, 2 * tp + fp + fn)), "iou": one(ratio(tp, tp + fp + fn))}


def object_scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1 of objects; 0 where nothing is there."""
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def f1_of(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def iou_of(f1: Column) -> Column:
    return f1 / (2 - f1)


def is_close(a: Column, b: Column, rel: float = 1e-3) -> Column:
    return F.abs(a - b) <= F.greatest(F.abs(a), F.abs(b)) * rel


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def bce(logit: Column, truth: Column, pos_weight: float = 1.0) -> Column:
    """Binary cross entropy of a logit, stable for large ones."""
    weight = 1 + (pos_weight - 1) * truth
    return (1 - truth) * logit + weight * (F.log1p(F.exp(-F.abs(logit))) + F.greatest(-logit, F.lit(0.0)))


def focal(logit: Column, truth: Column, gamma: float = 2.0, alpha: float | None = None, pos_weight: float = 1.0) -> Column:
    p = sigmoid(logit)
    right = p * truth + (1 - p) * (1 - truth)
    loss = F.pow(1 - right, F.lit(gamma)) * bce(logit, truth, pos_weight)
    return loss if alpha is None else (alpha * truth + (1 - alpha) * (1 - truth)) * loss


def dice_loss(p: Column, truth: Column, smooth: float = 1e-7) -> Column:
    """Aggregate over pixels."""
    return 1 - (2 * F.sum(p * truth) + smooth) / (F.sum(p) + F.sum(truth) + smooth)


def tversky_loss(p: Column, truth: Column, alpha: float = 0.5, beta: float = 0.5, smooth: float = 1e-7) -> Column:
    """Aggregate over pixels."""
    tp, fp, fn = F.sum(p * truth), F.sum(p * (1 - truth)), F.sum((1 - p) * truth)
    return 1 - (tp + smooth) / (tp + alpha * fp + beta * fn + smooth)


#: The names of losses and the parts that each adds up.
LOSSES = {
    "bce": ("bce",), "dice": ("dice",), "focal": ("focal",), "tversky": ("tversky",), "bce_dice": ("bce", "dice"), "focal_dice": ("focal", "dice"),
    "bce_tversky": ("bce", "tversky"), "focal_tversky": ("focal", "tversky"), "bce_focal_dice": ("bce", "focal", "dice"),
}


def segmentation_loss(name: str, logit: Column, truth: Column, weights: dict[str, float] | None = None, eps: float = 1e-7, pos_weight: float = 1.0, gamma: float = 2.0, focal_alpha: float | None = None, alpha: float = 0.5, beta: float = 0.5) -> Column:
    """Aggregate over pixels: a loss by its name, the sum of its parts, each by its weight (1); a name's parts may come in another order, and other names are bce_dice."""
    p = sigmoid(logit)
    parts = {
        "bce": F.avg(bce(logit, truth, pos_weight)), "focal": F.avg(focal(logit, truth, gamma, focal_alpha, pos_weight)),
        "dice": dice_loss(p, truth, eps), "tversky": tversky_loss(p, truth, alpha, beta, eps),
    }
    key = name.strip().lower().replace("binary_cross_entropy", "bce")
    known = next((v for k, v in LOSSES.items() if sorted(k.split("_")) == sorted(key.split("_"))), LOSSES["bce_dice"])
    return sum((parts[k] * (weights or {}).get(k, 1.0) for k in known), F.lit(0.0))


def quantized(p: Column) -> Column:
    """A probability as a byte, rounded half to even."""
    return F.rint(F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0)) * 255).cast("int")


#: Weights of a run's stages (all others weigh 1), and what a stage may call its progress, from 0 to 1.
STAGE_WEIGHTS = {"train_model": 5.0, "predict_validation_scenes": 3.0, "vectorize_validation_predictions": 2.0, "compute_f1": 2.0}
PROGRESS_KEYS = ("progress", "progress_fraction", "fraction")


def stage_fraction(payload: Column) -> Column:
    """How far a stage is by its payload (a map of texts), from 0 to 1; 0 if it does not say, or says no number."""
    given = F.coalesce(*(payload[k] for k in PROGRESS_KEYS))
    share = F.when(given.isNotNull(), given.try_cast("double")).otherwise(payload["progress_percent"].try_cast("double") / 100)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(share, F.lit(0.0))))


def progress_percent(stage: Column, done: Column, current: Column) -> Column:
    """Aggregate over a run's stages: percent done by weight, half to even; current is how far a stage is that is not done."""
    weight = F.lit(1.0)
    for name, w in STAGE_WEIGHTS.items():
        weight = F.when(stage == name, w).otherwise(weight)
    return F.rint(100.0 * F.sum(F.when(done, weight).otherwise(weight * current)) / F.sum(weight)).cast("int")
