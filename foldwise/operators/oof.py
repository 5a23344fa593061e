"""Out-of-fold predictions: a long table (index, target, model, fold, y, pred).

Linear family: one Gram pass over cells (outer fold x inner fold) gives every
fold's normal equations; ridge picks its alpha by exact leave-one-out in one
more vectorised scan; Bayesian ridge and elastic net (inner-fold CV on the
alpha path) are solved on the driver from p x p matrices.  All (target, model)
scores of a row come from one matrix product per Arrow batch, with the
coefficients of the row's own fold; rows never move.

Tree family: all fits (target x fold x candidate) are grown together on rows
that are binned once (see ``forests``), with fold-specific imputation; boosters
stop by patience on the validation rows while they grow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.exprs import inverse_bounded, inverse_floored, inverse_plain, log_target, stable_hash
from foldwise.operators import binning, forests, gram, models
from foldwise.operators.prep import PrepModel
from foldwise.operators.quantiles import ALL

ID = "index"


@dataclass
class OOFConfig:
    k: int = 5
    seed: int = 42
    seed_policy: str = "plus_fold"          # "plus_fold" (stacking) | "constant" (baseline)
    inverse: str = "floored"                # floored | plain | bounded
    inner_folds: int = 5
    candidates: tuple[str, ...] = models.CANDIDATES
    scale: str = "reference"
    tree_params: dict = field(default_factory=dict)   # candidate -> parameters over its preset (C22)
    max_parallel_fits: int = 4
    early_stop: str = "valid"               # "valid" (reference) | "inner" (hold-out inside train)


@dataclass
class LinearFit:
    scope: int
    target: str
    model: str
    beta: list[float]                       # over [x - c | z | 1]
    info: dict = field(default_factory=dict)


def _inverse(p: Column, use_log: bool, how: str) -> Column:
    if how == "plain":
        return inverse_plain(p, use_log)
    if how == "bounded":
        return inverse_bounded(p, use_log)
    return inverse_floored(p, use_log)


def _augmented(features: Sequence[str], centre: Sequence[float]) -> Column:
    xs = [F.coalesce(F.col(c).cast("double") - F.lit(float(centre[i])), F.lit(0.0)) for i, c in enumerate(features)]
    zs = [F.col(c).isNull().cast("double") for c in features]
    return F.array(*xs, *zs, F.lit(1.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, x: acc + x)


# ---------------------------------------------------------------- ridge LOO
def _loo_sse(p: int, t: int, alphas: np.ndarray, specs: dict):
    """mapInArrow body: sum of squared LOO residuals per (scope, target, alpha)."""

    def run(batches):
        acc: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            cols = batch.columns
            fold = cols[0].to_numpy(zero_copy_only=False).astype(np.int64)
            n = len(fold)
            if n == 0:
                continue
            a = np.empty((n, 2 * p + 1))
            for j in range(p):
                x = cols[1 + j].to_numpy(zero_copy_only=False).astype(np.float64)
                miss = np.isnan(x)
                a[:, j] = np.where(miss, 0.0, x - specs["centre"][j])
                a[:, p + j] = miss
            a[:, 2 * p] = 1.0
            ys = np.column_stack([cols[1 + p + j].to_numpy(zero_copy_only=False).astype(np.float64) for j in range(t)])
            for (scope, ti), sp in specs["fits"].items():
                rows = fold != scope if scope != ALL else np.ones(n, dtype=bool)
                if not rows.any():
                    continue
                xs = a[rows] @ sp["tmat"].T
                xc = xs[:, sp["idx"]] - sp["mean_x"][sp["idx"]]
                q = xc @ sp["vec"]
                d = 1.0 / (sp["lam"][None, :] + alphas[:, None])          # (n_alpha, p_active)
                fitted = q @ (sp["vtb"][None, :] * d).T                    # (rows, n_alpha)
                h = 1.0 / sp["n"] + (q * q) @ d.T
                r = (ys[rows, ti] - sp["mean_y"])[:, None] - fitted
                e = r / (1.0 - h)
                acc[(scope, ti)] = acc.get((scope, ti), 0.0) + (e * e).sum(axis=0)
        if acc:
            keys = list(acc)
            na = len(alphas)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([k[0] for k in keys], na).astype(np.int32)),
                 pa.array(np.repeat([k[1] for k in keys], na).astype(np.int32)),
                 pa.array(np.tile(np.arange(na), len(keys)).astype(np.int32)),
                 pa.array(np.concatenate([acc[k] for k in keys]))],
                names=["scope", "target", "alpha", "sse"])

    return run


# ---------------------------------------------------------------- linear family
def fit_linear(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]],
               full: PrepModel, per_fold: dict[int, PrepModel], cfg: OOFConfig,
               scopes: Sequence[int] | None = None, want: Sequence[str] = models.LINEAR,
               ridge_alphas: Sequence[float] | None = None, fold_col: str = "fold") -> tuple[list[LinearFit], list[float]]:
    """Coefficients of every linear candidate for every scope (a fold's training
    rows, or ALL rows for the final model).  ``df`` carries ``fold``."""
    want = [m for m in models.LINEAR if m in want]
    p, t = len(features), len(targets)
    stats = {**full.stats, **full.screened}
    centre = [float(stats[c].median) if c in stats and stats[c].median is not None else 0.0 for c in features]
    ycols = [log_target(name, use_log).alias(f"__y{i}") for i, (name, use_log) in enumerate(targets)]
    inner = (stable_hash(ID, cfg.seed + 7) % cfg.inner_folds).cast("int")
    base = df.select(ID, F.col(fold_col).cast("int").alias("fold"), *[F.col(c).cast("double").alias(c) for c in features], *ycols)
    cells = base.withColumn("__cell", F.col("fold") * F.lit(cfg.inner_folds) + inner)
    mom = gram.moments(cells, features, [f"__y{i}" for i in range(t)], "__cell", centre)
    k = cfg.k
    scopes = list(scopes) if scopes is not None else [*range(k), ALL]

    def cell_ids(scope: int, inner_in=None, inner_out=None):
        out = []
        for c in mom.cells:
            f, h = divmod(c, cfg.inner_folds)
            if scope != ALL and f == scope:
                continue
            if inner_in is not None and h != inner_in:
                continue
            if inner_out is not None and h == inner_out:
                continue
            out.append(c)
        return out

    fits: list[LinearFit] = []
    ridge_specs = {}
    designs = {}
    for s in scopes:
        prep_s = full if s == ALL else per_fold[s]
        tmat = gram.standardise_map(prep_s, features, centre)
        d = gram.design(mom.total(cell_ids(s)), tmat, p, t)
        designs[s] = d
        for ti, (name, _log) in enumerate(targets):
            if "ridge" in want:
                idx, lam, vec, vtb = gram.ridge_eigen(d)
                ridge_specs[(s, ti)] = dict(tmat=tmat, idx=idx, lam=lam, vec=vec, vtb=vtb[:, ti], mean_x=d.mean_x,
                                            mean_y=d.mean_y[ti], n=d.n)
            if "bayesian_ridge" in want:
                w, b0, info = gram.bayesian_ridge(d, ti, max_iter=500 if s != ALL else 800)
                fits.append(LinearFit(s, name, "bayesian_ridge", gram.raw_coefficients(d, w, b0).tolist(), info))
            if "elastic_net" in want:
                fits.append(_enet(mom, d, tmat, p, ti, name, s, cell_ids, cfg))
    if "ridge" in want:
        alphas = np.asarray(ridge_alphas if ridge_alphas is not None else gram.RIDGE_ALPHAS, dtype=np.float64)
        sse = (
            base.select("fold", *features, *[f"__y{i}" for i in range(t)]).mapInArrow(_loo_sse(p, t, alphas, {"centre": np.asarray(centre), "fits": ridge_specs}),
                            "scope int, target int, alpha int, sse double")
            .groupBy("scope", "target", "alpha").agg(F.sum("sse").alias("sse")).collect()
        )
        table: dict[tuple[int, int], np.ndarray] = {}
        for r in sse:
            table.setdefault((r.scope, r.target), np.full(len(alphas), np.inf))[r.alpha] = r.sse
        for (s, ti), v in table.items():
            best = int(np.argmin(v))
            d = designs[s]
            w, b0 = gram.ridge(d, float(alphas[best]), ti)
            fits.append(LinearFit(s, targets[ti][0], "ridge", gram.raw_coefficients(d, w, b0).tolist(),
                                  {"alpha": float(alphas[best])}))
    return fits, centre


def _enet(mom, d, tmat, p, ti, name, s, cell_ids, cfg) -> LinearFit:
    idx = np.flatnonzero(d.active)
    best = (np.inf, None, None)
    for r in models.ENET_L1_RATIOS:
        alphas = gram.enet_alphas(d.xty[idx, ti], d.n, r)
        mse = np.zeros(len(alphas))
        for h in range(cfg.inner_folds):
            tr_cells, va_cells = cell_ids(s, inner_out=h), cell_ids(s, inner_in=h)
            if not va_cells:
                continue
            dtr = gram.design(mom.total(tr_cells), tmat, p, d.mean_y.shape[0])
            va = mom.total(va_cells)
            n_va = va[2 * p, 2 * p]
            w_path = gram.enet_path(dtr.gram[np.ix_(idx, idx)], dtr.xty[idx, ti], dtr.n, alphas, r, dtr.yty[ti, ti])
            for ai in range(len(alphas)):
                w = np.zeros(p)
                w[idx] = w_path[:, ai]
                b0 = dtr.mean_y[ti] - dtr.mean_x @ w
                mse[ai] += gram.sse_from_moments(w, b0, va, tmat, p, ti) / max(n_va, 1.0) / cfg.inner_folds
        ai = int(np.argmin(mse))
        if mse[ai] < best[0]:
            best = (mse[ai], r, alphas[ai])
    _, r, a = best
    w = np.zeros(p)
    w[idx] = gram.enet_path(d.gram[np.ix_(idx, idx)], d.xty[idx, ti], d.n, [a], r, d.yty[ti, ti])[:, 0]
    b0 = d.mean_y[ti] - d.mean_x @ w
    return LinearFit(s, name, "elastic_net", gram.raw_coefficients(d, w, b0).tolist(), {"alpha": float(a), "l1_ratio": r})


def _linear_scores(width: int, centre: np.ndarray, scopes: np.ndarray, weights: np.ndarray, keep: Sequence[str], out: Sequence[str]):
    """mapInArrow body: columns ``keep`` as they are, then one score per column of the weights of the row's scope (NULL without one)."""

    def run(batches):
        for b in batches:
            n = b.num_rows
            scope = b["__scope"].to_numpy(zero_copy_only=False)
            a = np.ones((n, 2 * width + 1))
            for j in range(width):
                x = b[f"__x{j}"].to_numpy(zero_copy_only=False).astype(np.float64)
                miss = np.isnan(x)
                a[:, j], a[:, width + j] = np.where(miss, 0.0, x - centre[j]), miss
            scored = np.full((n, len(out)), np.nan)
            for k, s in enumerate(scopes):
                mine = scope == s
                if mine.any():
                    scored[mine] = a[mine] @ weights[k]
            known = np.isin(scope, scopes)
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in keep], *[pa.array(scored[:, i], mask=~known) for i in range(len(out))]],
                schema=pa.schema([*[b.schema.field(c) for c in keep], *[pa.field(c, pa.float64()) for c in out]]))

    return run


def score_linear(df: DataFrame, fits: Sequence[LinearFit], features: Sequence[str], centre: Sequence[float],
                 scope_col: str | None = "fold", prefix: str = "__lin") -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """``df`` with one raw score column per (target, model), and the columns' names: one row per row, no shuffle.

    With ``scope_col`` each row is scored by the model of its own fold (OOF),
    without it by the ALL-rows model (final / test)."""
    pairs = list(dict.fromkeys((f.target, f.model) for f in fits))
    names = {pair: f"{prefix}{i}" for i, pair in enumerate(pairs)}
    scopes = np.array(sorted({f.scope for f in fits}), np.int64)
    weights = np.full((len(scopes), 2 * len(features) + 1, len(pairs)), np.nan)
    for f in fits:
        weights[np.searchsorted(scopes, f.scope), :, pairs.index((f.target, f.model))] = f.beta
    scope = F.col(scope_col).cast("long") if scope_col else F.lit(ALL).cast("long")
    ready = df.select("*", F.coalesce(scope, F.lit(-(1 << 40))).alias("__scope"),
                      *[F.col(c).cast("double").alias(f"__x{j}") for j, c in enumerate(features)])
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in names.values()]])
    body = _linear_scores(len(features), np.asarray(centre, np.float64), scopes, weights, df.columns, list(names.values()))
    return ready.mapInArrow(body, schema), names


def apply_linear(df: DataFrame, fits: Sequence[LinearFit], features: Sequence[str], centre: Sequence[float],
                 targets: Sequence[tuple[str, bool]], inverse: str, scope_col: str | None = "fold") -> DataFrame:
    """Long predictions (index, target, model, fold, y, pred), of the model of each row's own fold, or without
    ``scope_col`` of the ALL-rows model."""
    logs = dict(targets)
    fold = F.col(scope_col).cast("int") if scope_col else F.lit(ALL)
    rows = df.select(ID, fold.alias("fold"), *dict.fromkeys([*features, *[t for t, _ in targets]]))
    scored, names = score_linear(rows, fits, features, centre, "fold")
    cells = [F.struct(F.lit(t).alias("target"), F.lit(m).alias("model"), F.col(t).cast("double").alias("y"),
                      _inverse(F.col(c), logs[t], inverse).alias("pred")) for (t, m), c in names.items()]
    return scored.select(ID, "fold", F.explode(F.array(*cells)).alias("__x")).select(
        ID, "__x.target", "__x.model", "fold", "__x.y", "__x.pred")


# ---------------------------------------------------------------- tree family
def _imputed_vector(features: Sequence[str], model: PrepModel) -> Column:
    vals = []
    for c in features:
        s = model.stats.get(c)
        if s is None:
            continue
        vals.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0 if s.median is None else s.median)))
    return F.array(*vals)


def _to_vector(arr: Column) -> Column:
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(arr)


#: parts of the blocks' rows: fold, hold-out inside the training rows
FOLD, INNER = 0, 1


def specs_of(names: Sequence[str], cfg) -> list[models.TreeSpec]:
    """Presets of tree candidates with the run's overlays."""
    return [models.replace_params(models.tree_spec(m, cfg.scale), cfg.tree_params.get(m, {})) for m in names]


def tree_table(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]], per_fold: dict[int, PrepModel],
               cfg: OOFConfig, specs: Sequence[models.TreeSpec], block_bytes: int | None = None
               ) -> tuple[forests.Table, list[tuple[str, str, int]]]:
    """Binned rows and one fit per (target, candidate, fold), with those keys.

    Missing values take the bin of the fold's own median, and a fit may use the
    features that its fold kept.  Cut points are the same for all folds (they
    know no target)."""
    used = [c for c in features if any(c in m.stats for m in per_fold.values())]
    bins = binning.fit_bins(df, used, ID)
    folds = sorted(per_fold)
    medians = [[per_fold[f].stats[c].median if c in per_fold[f].stats else None for c in used] for f in folds]
    inner = F.when(stable_hash(ID, cfg.seed + 11) % 10 == 0, F.lit(1)).otherwise(F.lit(0))
    t = len(targets)
    fits, keys = [], []
    for spec in specs:
        for f in folds:
            allowed = tuple(j for j, c in enumerate(used) if c in per_fold[f].stats)
            stop = None
            if spec.params.patience:
                # "inner" stops on a hash hold-out of the training rows, never on the scored fold
                stop = (INNER, 1) if cfg.early_stop == "inner" else (FOLD, f)
            seed = cfg.seed + f if cfg.seed_policy == "plus_fold" else cfg.seed
            for i, (name, _) in enumerate(targets):
                fits.append(forests.TreeFit(spec.name, i, spec.params, seed, folds.index(f), (FOLD, f), stop, allowed, shown=t + i))
                keys.append((name, spec.name, f))
    ys = [log_target(name, use_log) for name, use_log in targets] + [F.col(name) for name, _ in targets]
    return forests.prepare(df, bins, [F.col("fold"), inner], ys, medians, fits, ID, block_bytes), keys


def tree_oof_specs(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]], per_fold: dict[int, PrepModel],
                   cfg: OOFConfig, specs: Sequence[models.TreeSpec]) -> DataFrame:
    """OOF predictions of explicit tree specs, all fits grown together."""
    table, keys = tree_table(df, features, targets, per_fold, cfg, specs)
    logs = dict(targets)
    at = F.col("fit") + 1
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), at)
    raw = forests.held_predictions(table).withColumn("__log", pick([bool(logs[t]) for t, _, _ in keys]))
    pred = F.when(F.col("__log"), _inverse(F.col("pred"), True, cfg.inverse)).otherwise(_inverse(F.col("pred"), False, cfg.inverse))
    return raw.select(ID, pick([t for t, _, _ in keys]).alias("target"), pick([m for _, m, _ in keys]).alias("model"),
                      pick([f for _, _, f in keys]).cast("int").alias("fold"), "y", pred.alias("pred"))


def tree_oof(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]], full: PrepModel,
             per_fold: dict[int, PrepModel], cfg: OOFConfig, names: Sequence[str]) -> DataFrame | None:
    """OOF predictions of the tree candidates ``names``."""
    if not names:
        return None
    return tree_oof_specs(df, features, targets, per_fold, cfg, specs_of(names, cfg))


def fit_estimators(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]], model: PrepModel,
                   estimators: dict[str, object]) -> dict[tuple[str, str], object]:
    """A caller's ``pyspark.ml`` regressors, each fitted on all rows of ``df`` for each target (training space, imputed columns)."""
    vec = _to_vector(_imputed_vector(features, model))
    out = {}
    for name, use_log in targets:
        framed = df.select(log_target(name, use_log).alias("__y"), vec.alias("__v"))
        for m, est in estimators.items():
            out[(name, m)] = est.copy({est.getParam("featuresCol"): "__v", est.getParam("labelCol"): "__y"}).fit(framed)
    return out


def score_estimators(df: DataFrame, features: Sequence[str], model: PrepModel, fitted: dict[tuple[str, str], object],
                     prefix: str = "__est") -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """``df`` with one raw prediction column per fitted model, and the columns' names: rows do not move."""
    scored, names = df.withColumn("__v", _to_vector(_imputed_vector(features, model))), {}
    for i, (pair, fit) in enumerate(fitted.items()):
        names[pair] = f"{prefix}{i}"
        scored = fit.copy({fit.getParam("predictionCol"): names[pair]}).transform(scored)
    return scored.select(*df.columns, *names.values()), names


def estimator_oof(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]], per_fold: dict[int, PrepModel],
                  cfg: OOFConfig, estimators: dict[str, object]) -> DataFrame:
    """OOF predictions of a caller's estimators: every fold's rows are read once and scored by all of its models."""
    logs, out = dict(targets), None
    for f in sorted(per_fold):
        fitted = fit_estimators(df.filter(F.col("fold") != f), features, targets, per_fold[f], estimators)
        scored, names = score_estimators(df.filter(F.col("fold") == f), features, per_fold[f], fitted)
        cells = [F.struct(F.lit(t).alias("target"), F.lit(m).alias("model"), F.col(t).cast("double").alias("y"),
                          _inverse(F.col(c), logs[t], cfg.inverse).alias("pred")) for (t, m), c in names.items()]
        part = scored.select(ID, F.explode(F.array(*cells)).alias("__x")).select(
            ID, "__x.target", "__x.model", F.lit(f).alias("fold"), "__x.y", "__x.pred")
        out = part if out is None else out.unionByName(part)
    return out


def collect_oof(df: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, bool]], full: PrepModel,
                per_fold: dict[int, PrepModel], cfg: OOFConfig) -> tuple[DataFrame, list[LinearFit], list[float]]:
    """The long OOF table of every requested candidate."""
    lin = [m for m in cfg.candidates if m in models.LINEAR]
    trees = [m for m in cfg.candidates if m not in models.LINEAR]
    fits, centre = fit_linear(df, features, targets, full, per_fold, cfg, scopes=list(range(cfg.k)), want=lin) if lin else ([], [])
    parts = []
    if fits:
        parts.append(apply_linear(df, fits, features, centre, targets, cfg.inverse, "fold"))
    t = tree_oof(df, features, targets, full, per_fold, cfg, trees)
    if t is not None:
        parts.append(t)
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out, fits, centre


def evaluate_cv(build_estimator, df: DataFrame, features: Sequence[str], target: str, per_fold: dict[int, PrepModel],
                k: int) -> tuple[float, list[float]]:
    """A fresh estimator per fold (``build_estimator()`` returns a pyspark.ml
    regressor reading ``__v`` / ``__y``), RMSE per fold and their plain mean."""
    scores = []
    for f in range(k):
        vec = _to_vector(_imputed_vector(features, per_fold[f]))
        framed = df.select(F.col("fold").cast("int").alias("fold"), F.col(target).cast("double").alias("__y"), vec.alias("__v"))
        model = build_estimator().fit(framed.filter(F.col("fold") != f))
        r = model.transform(framed.filter(F.col("fold") == f)).agg(
            F.sqrt(F.avg((F.col("__y") - F.col("prediction")) ** 2)).alias("r")).first().r
        scores.append(float(r))
    return float(np.mean(scores)), scores
