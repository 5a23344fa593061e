"""Scores and simple ensembles over the long OOF table.

The OOF table is long: (index, target, model, fold, y, pred).  Every metric
is a grouped aggregate on it, so nothing row-level reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.exprs import rmse_expr

WEIGHT_EPS = 1e-8  # fixed value: 1 / (rmse + 1e-8)


def rmse_by(oof: DataFrame, keys: Sequence[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """A1 per group: sqrt(mean((y - pred)^2))."""
    return oof.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), rmse_expr(y, pred).alias("rmse"))


def competition_score(per_target: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over targets of the per-target RMSE (``per_target`` from rmse_by)."""
    return per_target.groupBy(*keys).agg(F.avg("rmse").alias("score"), F.count(F.lit(1)).alias("n_targets"))


def mean_fold_rmse(oof: DataFrame, keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """Unweighted mean of per-fold RMSEs (differs from the pooled RMSE)."""
    per_fold = rmse_by(oof, [*keys, "fold"])
    return per_fold.groupBy(*keys).agg(F.avg("rmse").alias("mean_fold_rmse"), F.count(F.lit(1)).alias("n_folds"))


def inverse_rmse_weights(oof: DataFrame) -> DataFrame:
    """w_j = (1/(rmse_j + 1e-8)) / sum_k 1/(rmse_k + 1e-8), per target."""
    r = rmse_by(oof, ["target", "model"]).withColumn("inv", 1.0 / (F.col("rmse") + F.lit(WEIGHT_EPS)))
    w = Window.partitionBy("target")
    return r.select("target", "model", "rmse", (F.col("inv") / F.sum("inv").over(w)).alias("weight"))


def weighted_blend(oof: DataFrame, weights: DataFrame, keys: Sequence[str] = ("index", "target")) -> DataFrame:
    """sum_j w_j * pred_j per (index, target).  ``weights`` is (target, model, weight),
    bounded by #targets x #models, so it is broadcast."""
    return (
        oof.join(F.broadcast(weights.select("target", "model", "weight")), ["target", "model"])
        .groupBy(*keys)
        .agg(F.first("y").alias("y"), F.sum(F.col("weight") * F.col("pred")).alias("pred"))
    )


def weighted_ensemble(preds: DataFrame, weights: DataFrame | None, keys: Sequence[str] = ("index", "target")) -> DataFrame:
    """sum(w * p) / sum(w) with w = 1.0 for a model that has no weight."""
    if weights is None:
        joined = preds.withColumn("weight", F.lit(1.0))
    else:
        joined = preds.join(F.broadcast(weights.select("target", "model", "weight")), ["target", "model"], "left")
    w = F.coalesce(F.col("weight"), F.lit(1.0))
    return joined.groupBy(*keys).agg((F.sum(w * F.col("pred")) / F.sum(w)).alias("pred"))
