"""Preprocessor: missing-ratio and variance screening, median impute, standardise.

Fit = three bounded passes, whatever the number of folds:
  1. per (fold, feature) row and non-NULL counts     -> missing ratios
  2. exact medians of every scope (radix selection)  -> imputation values
  3. per (fold, feature) sums of (x - c) and (x - c)^2, c = overall median
A scope is either ALL rows or "every fold but f"; complements are totals minus
the fold's own sums, so k fold fits cost the same scans as one.  Imputed rows
contribute exactly 0 to the sums around their median, which gives mean and
variance of the imputed column in closed form.

The fitted model is a small statistics table (one row per scope x feature);
``transform`` is a single projection with the statistics as literals.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.quantiles import ALL, medians
from foldwise.sources.files import numeric_columns

VARIANCE_EPS = 1e-12           # fixed value: zero-variance screen
DEFAULT_MISSING_THRESHOLD = 0.3  # fixed value: drop columns with more missing than this


@dataclass
class FeatureStats:
    feature: str
    n_rows: int
    n_present: int
    median: float | None
    mean: float | None
    std: float | None          # population std (ddof 0) of the imputed column
    var_samp: float | None     # sample variance (ddof 1) of the imputed column

    @property
    def missing_ratio(self) -> float:
        return (self.n_rows - self.n_present) / self.n_rows if self.n_rows else float("nan")

    @property
    def scale(self) -> float:
        """Scaler divisor: std, or 1.0 for a constant column."""
        if self.std is None or not self.std > 10 * 2.220446049250313e-16:
            return 1.0
        return self.std


@dataclass
class PrepModel:
    features: list[str]                     # kept, in input order
    dropped: list[str]                      # sorted
    stats: dict[str, FeatureStats]          # over the fitted scope
    missing_threshold: float = DEFAULT_MISSING_THRESHOLD
    scope: int = ALL
    screened: dict[str, FeatureStats] = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        return list(self.features)

    def columns(self) -> dict[str, Column]:
        """(coalesce(x, median) - mean) / scale for every kept feature."""
        out = {}
        for c in self.features:
            s = self.stats[c]
            med = 0.0 if s.median is None else s.median
            mean = 0.0 if s.mean is None else s.mean
            out[c] = (F.coalesce(F.col(c).cast("double"), F.lit(med)) - F.lit(mean)) / F.lit(s.scale)
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"missing fitted features: {sorted(missing)[:10]}")
        cols = self.columns()
        return df.select(*keep, *[e.alias(c) for c, e in cols.items()])

    def stats_rows(self) -> list[tuple]:
        rows = []
        for c, s in {**self.stats, **self.screened}.items():
            rows.append((self.scope, c, s.missing_ratio, s.median, s.mean, s.std, s.var_samp, c in self.features))
        return rows

    def stats_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.stats_rows(),
            "scope int, feature string, missing_ratio double, median double, mean double, std double, var_samp double, kept boolean",
        )

    # ---- S8: persistence as a readable JSON document ----------------------
    def to_json(self) -> str:
        return json.dumps({
            "features": self.features, "dropped": self.dropped, "scope": self.scope,
            "missing_threshold": self.missing_threshold,
            "stats": {c: vars(s) for c, s in self.stats.items()},
            "screened": {c: vars(s) for c, s in self.screened.items()},
        })

    @classmethod
    def from_json(cls, text: str) -> PrepModel:
        d = json.loads(text)
        return cls(
            features=d["features"], dropped=d["dropped"], scope=d["scope"],
            missing_threshold=d["missing_threshold"],
            stats={c: FeatureStats(**v) for c, v in d["stats"].items()},
            screened={c: FeatureStats(**v) for c, v in d["screened"].items()},
        )

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "model string").write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PrepModel:
        rows = [r[0] for r in spark.read.text(path).collect() if r[0]]
        if not rows:
            raise FileNotFoundError(path)
        return cls.from_json(rows[0])


def _scope_stats(df: DataFrame, cols: Sequence[str], fold_col: str | None, folds: Sequence[int]) -> dict[tuple[int, str], FeatureStats]:
    """FeatureStats for every (scope, feature) in three passes over one
    persisted copy of the input (the upstream plan runs once)."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _scope_stats_on(df, cols, fold_col, folds)
    finally:
        df.unpersist()


def _scope_stats_on(df: DataFrame, cols: Sequence[str], fold_col: str | None, folds: Sequence[int]) -> dict[tuple[int, str], FeatureStats]:
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    # pass 1 + 3 share the grouping; pass 2 (medians) needs pass-1-free radix passes
    meds = medians(df, cols, fold_col=fold_col, folds=list(folds) if fold_col else None)
    centre = {c: (meds.get((c, ALL)) or 0.0) for c in cols}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        d = F.col(c).cast("double") - F.lit(centre[c])
        aggs += [F.count(F.col(c)).alias(f"n{i}"), F.sum(d).alias(f"s{i}"), F.sum(d * d).alias(f"q{i}")]
    per_fold = {r["__fold"]: r for r in df.groupBy(fold.alias("__fold")).agg(*aggs).collect()}

    def total(key: str, skip: int | None) -> float:
        return sum((r[key] or 0) for f, r in per_fold.items() if f != skip)

    out: dict[tuple[int, str], FeatureStats] = {}
    scopes = [ALL] + (list(folds) if fold_col else [])
    for s in scopes:
        skip = None if s == ALL else s
        n = int(total("__rows", skip))
        for i, c in enumerate(cols):
            cnt = int(total(f"n{i}", skip))
            med = meds.get((c, s))
            if cnt == 0 or med is None:
                out[(s, c)] = FeatureStats(c, n, cnt, None, None, None, None)
                continue
            shift = med - centre[c]
            s1 = total(f"s{i}", skip) - cnt * shift            # sum of (x - med) over present values
            s2 = total(f"q{i}", skip) - 2 * shift * total(f"s{i}", skip) + cnt * shift * shift
            mean_dev = s1 / n
            var_pop = max(s2 / n - mean_dev * mean_dev, 0.0)
            var_samp = var_pop * n / (n - 1) if n > 1 else None
            out[(s, c)] = FeatureStats(c, n, cnt, med, med + mean_dev, math.sqrt(var_pop), var_samp)
    return out


def _screen(stats: dict[str, FeatureStats], cols: Sequence[str], threshold: float) -> tuple[list[str], list[str]]:
    drop_missing = [c for c in cols if stats[c].missing_ratio > threshold]
    drop_var = [c for c in cols if stats[c].var_samp is not None and stats[c].var_samp <= VARIANCE_EPS]
    dropped = sorted(set(drop_missing + drop_var))
    return [c for c in cols if c not in dropped], dropped


def feature_candidates(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    cols = numeric_columns(df, exclude)
    if not cols:
        raise ValueError("no numeric columns to fit the preprocessor on")
    return cols


def fit(df: DataFrame, *, exclude: Sequence[str] = (), features: Sequence[str] | None = None,
        missing_threshold: float = DEFAULT_MISSING_THRESHOLD) -> PrepModel:
    """M1: full fit on every row of ``df``."""
    cols = list(features) if features is not None else feature_candidates(df, exclude)
    st = _scope_stats(df, cols, None, [])
    stats = {c: st[(ALL, c)] for c in cols}
    kept, dropped = _screen(stats, cols, missing_threshold)
    return PrepModel(kept, dropped, {c: stats[c] for c in kept}, missing_threshold, ALL,
                     {c: stats[c] for c in dropped})


def fit_folds(df: DataFrame, fold_col: str, folds: Sequence[int], *, schema: PrepModel | None = None,
              exclude: Sequence[str] = (), missing_threshold: float = DEFAULT_MISSING_THRESHOLD,
              features: Sequence[str] | None = None) -> dict[int, PrepModel]:
    """M2 / M6: one model per fold, fitted on the rows of the other folds.

    With ``schema`` (frozen, M2) the kept columns are copied from that full fit
    and only medians and scaler come from the fold's training rows; without it
    (free, M6) every fold screens its own columns."""
    if schema is not None:
        cols = list(schema.features)
    else:
        cols = list(features) if features is not None else feature_candidates(df, exclude)
    st = _scope_stats(df, cols, fold_col, folds)
    out = {}
    for f in folds:
        stats = {c: st[(f, c)] for c in cols}
        if schema is not None:
            kept, dropped = list(schema.features), list(schema.dropped)
        else:
            kept, dropped = _screen(stats, cols, missing_threshold)
        out[f] = PrepModel(kept, dropped, {c: stats[c] for c in kept},
                           schema.missing_threshold if schema else missing_threshold, f,
                           {c: stats[c] for c in cols if c not in kept})
    return out


def fit_with_folds(df: DataFrame, fold_col: str, folds: Sequence[int], *, exclude: Sequence[str] = (),
                   features: Sequence[str] | None = None, missing_threshold: float = DEFAULT_MISSING_THRESHOLD,
                   frozen: bool = True) -> tuple[PrepModel, dict[int, PrepModel]]:
    """M1 + M2 (or M6 with ``frozen=False``) from one set of passes: the full fit
    is the ALL scope of the same statistics."""
    cols = list(features) if features is not None else feature_candidates(df, exclude)
    st = _scope_stats(df, cols, fold_col, folds)
    stats = {c: st[(ALL, c)] for c in cols}
    kept, dropped = _screen(stats, cols, missing_threshold)
    full = PrepModel(kept, dropped, {c: stats[c] for c in kept}, missing_threshold, ALL, {c: stats[c] for c in dropped})
    per = {}
    for f in folds:
        fs = {c: st[(f, c)] for c in cols}
        if frozen:
            k_f, d_f = list(kept), list(dropped)
        else:
            k_f, d_f = _screen(fs, cols, missing_threshold)
        per[f] = PrepModel(k_f, d_f, {c: fs[c] for c in k_f}, missing_threshold, f, {c: fs[c] for c in cols if c not in k_f})
    return full, per


def fit_scalers(df: DataFrame, cols: Sequence[str], fold_col: str | None = None, folds: Sequence[int] = ()) -> tuple[PrepModel, dict[int, PrepModel]]:
    """Standard scalers only (mean, population std) for NULL-free columns, e.g.
    base-model predictions at the meta level: two aggregate passes, no medians."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    centre = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first().asDict()
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        d = F.col(c).cast("double") - F.lit(centre[c] or 0.0)
        aggs += [F.count(F.col(c)).alias(f"n{i}"), F.sum(d).alias(f"s{i}"), F.sum(d * d).alias(f"q{i}")]
    per_fold = {r["__fold"]: r for r in df.groupBy(fold.alias("__fold")).agg(*aggs).collect()}

    def model(skip):
        stats = {}
        n = sum(r["__rows"] for f, r in per_fold.items() if f != skip)
        for i, c in enumerate(cols):
            s1 = sum((r[f"s{i}"] or 0.0) for f, r in per_fold.items() if f != skip)
            s2 = sum((r[f"q{i}"] or 0.0) for f, r in per_fold.items() if f != skip)
            cnt = sum(r[f"n{i}"] for f, r in per_fold.items() if f != skip)
            mean_dev = s1 / n
            var_pop = max(s2 / n - mean_dev * mean_dev, 0.0)
            stats[c] = FeatureStats(c, n, cnt, None, (centre[c] or 0.0) + mean_dev, math.sqrt(var_pop),
                                    var_pop * n / (n - 1) if n > 1 else None)
        return PrepModel(list(cols), [], stats, 1.0, ALL if skip is None else skip)

    return model(None), {f: model(f) for f in folds}


def missing_ratios(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: share of NULL per column, one aggregate, long output (column, missing_ratio)."""
    agg = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return agg.unpivot([], list(cols), "column", "missing_ratio")
