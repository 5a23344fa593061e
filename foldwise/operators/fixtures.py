"""V5: a fold-complement OOF table derived from the assay view by arithmetic only.

Two simple per-fold models, fitted on the rows of the other folds:
  m_mean  the target mean
  m_lin   least squares of the target on one feature whose NULLs are imputed
          with the median of that feature over the same rows
Per-fold sums are grouped by fold once (k rows to the driver); the complement
of fold f is total minus f.  The model parameters (k x targets rows) go back
to the executors as a broadcast table; the OOF table itself stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.quantiles import medians
from foldwise.session import cut_lineage
from foldwise.sources.views import ID, TARGETS

N_FOLDS = 5


def _long_targets(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return df.select(
        ID, "fold", "x",
        F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in targets])).alias("ty"),
    ).select(ID, "fold", "x", "ty.target", "ty.y")


def linear_oof(train: DataFrame, feature: str = "sum_qty", targets: Sequence[str] = TARGETS,
               n_folds: int = N_FOLDS, fold_expr=None) -> DataFrame:
    """Long OOF table (index, target, model, fold, y, pred) of m_mean and m_lin,
    checkpointed into the shared folder.

    The input (a join over the largest tables) feeds the median passes, the
    centring aggregate, the per-fold sums and the scoring pass: it is persisted
    once and released after the OOF table is written."""
    fold = fold_expr if fold_expr is not None else (F.col(ID) % n_folds).cast("int")
    base = train.select(ID, fold.alias("fold"), F.col(feature).cast("double").alias("x"), *targets)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cut_lineage(_linear_oof(base, targets, n_folds), spread=True)
    finally:
        base.unpersist()


def _linear_oof(base: DataFrame, targets: Sequence[str], n_folds: int) -> DataFrame:
    spark = base.sparkSession
    folds = list(range(n_folds))
    med = medians(base, ["x"], fold_col="fold", folds=folds, include_all=True)
    centre_x = med[("x", -1)] or 0.0
    long = _long_targets(base, targets)
    # per (fold, target) sums around fixed centres (overall median of x, first-pass mean of y)
    centre_y = {r.target: r.m for r in long.groupBy("target").agg(F.avg("y").alias("m")).collect()}
    cy = F.col("y") - F.col("cy")
    dx = F.col("x") - F.lit(centre_x)
    ycent = spark.createDataFrame([(t, float(v)) for t, v in centre_y.items()], "target string, cy double")
    sums = (
        long.join(F.broadcast(ycent), "target")
        .groupBy("fold", "target")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count("x").alias("nx"),
            F.sum(dx).alias("sx"), F.sum(dx * dx).alias("sxx"), F.sum(F.when(F.col("x").isNotNull(), dx * cy)).alias("sxy"),
            F.sum(cy).alias("sy"), F.sum(F.when(F.col("x").isNull(), cy)).alias("sy_miss"),
        )
        .collect()
    )
    acc: dict[tuple[int, str], dict[str, float]] = {(r.fold, r.target): r.asDict() for r in sums}
    params = []
    for t in targets:
        for f in folds:
            rows = [v for (ff, tt), v in acc.items() if tt == t and ff != f]
            tot = {k: sum((r[k] or 0) for r in rows) for k in ("n", "nx", "sx", "sxx", "sxy", "sy", "sy_miss")}
            n = tot["n"]
            mean_y = centre_y[t] + tot["sy"] / n
            m = med[("x", f)]
            dm = (m if m is not None else centre_x) - centre_x
            n_miss = n - tot["nx"]
            # sums of the imputed x (around centre_x) and y (around centre_y)
            sx = tot["sx"] + n_miss * dm
            sxx = tot["sxx"] + n_miss * dm * dm
            sxy = tot["sxy"] + dm * tot["sy_miss"]
            sy = tot["sy"]
            cov = sxy - sx * sy / n
            var = sxx - sx * sx / n
            slope = cov / var if var > 0 else None
            intercept = None if slope is None else mean_y - slope * (centre_x + sx / n)
            params.append((f, t, float(mean_y), slope, intercept, float(dm + centre_x)))
    ptab = spark.createDataFrame(params, "fold int, target string, mean_y double, slope double, intercept double, x_fill double")
    scored = long.join(F.broadcast(ptab), ["fold", "target"])
    x_imp = F.coalesce(F.col("x"), F.col("x_fill"))
    return scored.select(
        ID, "target", "fold", "y",
        F.explode(F.array(
            F.struct(F.lit("m_mean").alias("model"), F.col("mean_y").alias("pred")),
            F.struct(F.lit("m_lin").alias("model"), (F.col("intercept") + F.col("slope") * x_imp).alias("pred")),
        )).alias("mp"),
    ).select(ID, "target", F.col("mp.model").alias("model"), "fold", "y", F.col("mp.pred").alias("pred"))
