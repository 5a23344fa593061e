"""Gram, linear models, OOF, stacking and blending queries (steps 6-8)."""

from __future__ import annotations

import concurrent.futures as cf

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import binning, blend, decompose, folds, forests, gram, metrics, models, oof, prep
from foldwise.operators.quantiles import ALL
from foldwise.operators.trees import TreeParams
from foldwise.plans.core_queries import FEATURES, _cte, _oof_sql, assay_features, assay_oof
from foldwise.plans.registry import register
from foldwise.session import cut_lineage
from foldwise.plans.rounding import sig, sql_sig
from foldwise.sources import views
from foldwise.sources.views import ID, LOG_TARGETS, TARGETS

K = 5
SEED = 42
TARGET_SPECS = [(t, t in LOG_TARGETS) for t in TARGETS]
GRAM_FEATURES = ("n_lines", "sum_qty", "avg_price", "avg_disc", "max_tax")
_H = "('0x' || substr(md5(CAST(\"index\" AS VARCHAR) || ':42'), 1, 8))::BIGINT"


def fold_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold-tagged training table, checkpointed: every later pass reads it."""
    return cut_lineage(folds.hash_kfold(views.train_part(assay_features(spark, sf_dir)), K, SEED), spread=True)


def fitted_prep(tr: DataFrame):
    return prep.fit_with_folds(tr, "fold", list(range(K)), features=FEATURES)


# ---------------------------------------------------------------- G
def _gram_sql() -> str:
    p = len(GRAM_FEATURES)
    cols = [f"coalesce({c} - md.c{i}, 0.0) AS a{i}" for i, c in enumerate(GRAM_FEATURES)]
    cols += [f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END AS a{p + i}" for i, c in enumerate(GRAM_FEATURES)]
    cols += [f"1.0 AS a{2 * p}", f"t1 AS a{2 * p + 1}"]
    m = 2 * p + 2
    parts = [f"SELECT cell, {i} AS i, {j} AS j, {sql_sig(f'sum(a{i} * a{j})', 6)} AS v FROM av GROUP BY cell"
             for i in range(m) for j in range(i, m)]
    return f"""WITH {_cte()}, tr AS (SELECT *, CAST({_H} % {K} AS INTEGER) AS cell FROM af WHERE NOT is_test),
md AS (SELECT {', '.join(f'median({c}) AS c{i}' for i, c in enumerate(GRAM_FEATURES))} FROM tr),
av AS (SELECT cell, {', '.join(cols)} FROM tr, md)
{chr(10).join(('UNION ALL ' if k else '') + q for k, q in enumerate(parts))}"""


@register("gram_pairs", _gram_sql())
def gram_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G: per-fold moment matrices of [x - median | NULL flags | 1 | y] from one mapInArrow pass."""
    tr = fold_frame(spark, sf_dir)
    full = prep.fit(tr, features=list(GRAM_FEATURES))
    centre = [full.stats[c].median for c in GRAM_FEATURES]
    mom = gram.moments(tr, GRAM_FEATURES, ["t1"], "fold", centre)
    rows = [(int(c), i, j, float(mat[i, j])) for c, mat in mom.cells.items() for i in range(mom.m) for j in range(i, mom.m)]
    df = spark.createDataFrame(rows, "cell int, i int, j int, v double")
    return df.select("cell", "i", "j", sig(F.col("v"), 6).alias("v"))


# ---------------------------------------------------------------- M8 PCA
def _embedding_pca(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, decompose.PCAModel]:
    wide = views.wide(spark, sf_dir)
    return wide, decompose.fit_pca(wide, [c for c in wide.columns if c.startswith("e")])


@register("pca_variance")
def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + W1: PCA of the standardised (0-filled) embedding dimensions: explained-variance
    ratio and its cumulative sum per component."""
    df = _embedding_pca(spark, sf_dir)[1].variance_frame(spark)
    return df.select("component", sig(F.col("explained_variance_ratio"), 8).alias("explained_variance_ratio"),
                     sig(F.col("cumulative"), 8).alias("cumulative"))


_DIMS = 64
_PCA_MOMENTS_SQL = f"""WITH w AS (SELECT vec_id, unnest(range({_DIMS})) AS d, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS v FROM embeddings),
c AS (SELECT l.d AS a, r.d AS b, corr(l.v, r.v) AS r FROM w l JOIN w r ON l.vec_id = r.vec_id GROUP BY l.d, r.d),
t AS (SELECT x.a, y.b, sum(x.r * y.r) AS r2 FROM c x JOIN c y ON x.b = y.a GROUP BY x.a, y.b)
SELECT CAST({_DIMS} AS BIGINT) AS n_components, {sql_sig('(SELECT sum(r) FROM c WHERE a = b)', 9)} AS sum_1,
       {sql_sig('(SELECT sum(r * r) FROM c)', 9)} AS sum_2, {sql_sig('(SELECT sum(c.r * t.r2) FROM c JOIN t ON c.a = t.a AND c.b = t.b)', 9)} AS sum_3"""


@register("pca_moments", _PCA_MOMENTS_SQL)
def pca_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: sums of the first three powers of the eigenvalues, which are the traces of the powers of the correlation matrix."""
    lam = np.array(_embedding_pca(spark, sf_dir)[1].eigenvalues)
    df = spark.createDataFrame([(len(lam), float(lam.sum()), float((lam**2).sum()), float((lam**3).sum()))],
                               "n_components bigint, sum_1 double, sum_2 double, sum_3 double")
    return df.select("n_components", *[sig(F.col(f"sum_{k}"), 9).alias(f"sum_{k}") for k in (1, 2, 3)])


# ---------------------------------------------------------------- linear fits
def _linear(tr: DataFrame):
    """Linear fits of every fold and of all rows of the fold frame ``tr``."""
    full, per = fitted_prep(tr)
    cfg = oof.OOFConfig(k=K, seed=SEED, candidates=models.LINEAR)
    fits, centre = oof.fit_linear(tr, FEATURES, TARGET_SPECS, full, per, cfg)
    return fits, centre


def _fits_frame(spark, fits, model, keys):
    rows = [(f.scope, f.target, *[None if f.info.get(k) is None else float(f.info[k]) for k in keys], float(f.beta[-1]),
             int(sum(1 for b in f.beta[:-1] if abs(b) > 0))) for f in fits if f.model == model]
    schema = "scope int, target string, " + ", ".join(f"{k} double" for k in keys) + ", intercept double, nonzero int"
    df = spark.createDataFrame(rows, schema)
    return df.select("scope", "target", *[sig(F.col(k), 8).alias(k) for k in keys], sig(F.col("intercept"), 8).alias("intercept"), "nonzero")


@register("ridge_loo")
def ridge_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge with exact leave-one-out alpha over logspace(-4, 4, 25), per fold and final."""
    fits, _ = _linear(fold_frame(spark, sf_dir))
    return _fits_frame(spark, fits, "ridge", ["alpha"])


@register("bayes_ridge")
def bayes_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bayesian ridge (evidence maximisation) per fold and final."""
    fits, _ = _linear(fold_frame(spark, sf_dir))
    return _fits_frame(spark, fits, "bayesian_ridge", ["alpha", "lambda"])


@register("elastic_net_cv")
def elastic_net_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elastic net with (alpha, l1_ratio) chosen by inner 5-fold CV on the Gram cells."""
    fits, _ = _linear(fold_frame(spark, sf_dir))
    return _fits_frame(spark, fits, "elastic_net", ["alpha", "l1_ratio"])


def _linear_oof(tr: DataFrame, fits, centre) -> DataFrame:
    lin = oof.apply_linear(tr, [f for f in fits if f.scope != ALL], FEATURES, centre, TARGET_SPECS, "floored", "fold")
    # the OOF table is the materialisation point: cut the lineage into the shared checkpoint folder
    return cut_lineage(lin, spread=True)


def _fitted_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr = fold_frame(spark, sf_dir)
    return _linear_oof(tr, *_linear(tr))


def _rmse_table(o: DataFrame) -> DataFrame:
    r = metrics.rmse_by(o, ["target", "model"])
    return r.select("target", "model", F.col("n").cast("bigint").alias("n"), sig(F.col("rmse"), 8).alias("rmse"))


@register("oof_linear")
def oof_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OOF predictions of the linear family (floored inverse), RMSE per target/model."""
    return _rmse_table(_fitted_oof(spark, sf_dir))


@register("oof_leaderboard")
def oof_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C25 + T3 + C26: per model, RMSE per target, the mean score, rank, divergence flag."""
    r = metrics.rmse_by(_fitted_oof(spark, sf_dir), ["target", "model"])
    per_model = r.groupBy("model").agg(
        F.avg("rmse").alias("oof_score"),
        *[F.max(F.when(F.col("target") == t, F.col("rmse"))).alias(f"rmse_{t}") for t in TARGETS])
    from pyspark.sql import Window

    ranked = per_model.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("oof_score", "model")))
    return ranked.select("model", "rank", F.round("oof_score", 2).alias("oof_score"),
                         *[F.round(f"rmse_{t}", 2).alias(f"rmse_{t}") for t in TARGETS],
                         (F.col("oof_score") > 2000).alias("diverged"))


@register("oof_trees")
def oof_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OOF predictions of the six tree candidates at the reference presets, all fits grown together."""
    tr = fold_frame(spark, sf_dir)
    full, per = fitted_prep(tr)
    cfg = oof.OOFConfig(k=K, seed=SEED, candidates=tuple(m for m in models.CANDIDATES if m not in models.LINEAR))
    t = oof.tree_oof(tr, FEATURES, TARGET_SPECS, full, per, cfg, list(cfg.candidates))
    return _rmse_table(t)


def _metas(lin: DataFrame, names: list[str]) -> list:
    """Per-target nested meta ridge, the independent fits submitted together."""
    with cf.ThreadPoolExecutor(max_workers=len(TARGETS)) as pool:
        return list(pool.map(lambda t: blend.meta_oof_ridge(lin, t, names, K, SEED), TARGETS))


@register("meta_oof")
def meta_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 + M20: nested meta-ridge OOF per target next to the in-sample meta score."""
    lin = _fitted_oof(spark, sf_dir)
    names = list(models.LINEAR)
    out = []
    for t, m in zip(TARGETS, _metas(lin, names)):
        nested = metrics.rmse_by(m.oof_meta, ["target", "model"])
        insample = metrics.rmse_by(blend.meta_in_sample(lin, m, names), ["target", "model"])
        out.append(nested.unionByName(insample))
    df = out[0]
    for d in out[1:]:
        df = df.unionByName(d)
    return df.select("target", "model", F.col("n").cast("bigint").alias("n"), sig(F.col("rmse"), 8).alias("rmse"))


@register("stacked_predict")
def stacked_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14 + C15 + P15: final linear models on all train rows, meta per target,
    predictions for the test rows, floors; summary per target."""
    af = assay_features(spark, sf_dir)
    tr = fold_frame(spark, sf_dir)
    fits, centre = _linear(tr)
    lin = _linear_oof(tr, fits, centre)
    names = list(models.LINEAR)
    metas = dict(zip(TARGETS, _metas(lin, names)))
    test = views.test_part(af)
    base = oof.apply_linear(test, [f for f in fits if f.scope == ALL], FEATURES, centre, TARGET_SPECS, "plain", None)
    pred = blend.stacked_predict(base, metas, names)
    from foldwise.functions.exprs import TARGET_FLOOR, floor_at

    pred = pred.select(ID, floor_at("t1", TARGET_FLOOR).alias("t1"), floor_at("t2", TARGET_FLOOR).alias("t2"),
                       floor_at("t3", 0.0).alias("t3"))
    long = pred.select(ID, F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("pred")) for t in TARGETS])).alias("x"))
    return long.groupBy(F.col("x.target").alias("target")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), sig(F.min("x.pred"), 6).alias("min_pred"),
        sig(F.max("x.pred"), 6).alias("max_pred"), sig(F.avg("x.pred"), 6).alias("mean_pred"))


# ---------------------------------------------------------------- C17 on V5
_GRID_SQL = f"""WITH {_oof_sql()},
lin AS (SELECT "index", max(CASE WHEN target = 't1' THEN pred END) AS p1, max(CASE WHEN target = 't2' THEN pred END) AS p2,
               max(CASE WHEN target = 't3' THEN pred END) AS p3, max(CASE WHEN target = 't3' THEN y END) AS y3
        FROM oof WHERE model = 'm_lin' GROUP BY "index"),
g AS (SELECT CAST(i AS DOUBLE) / 40.0 AS w FROM range(41) t(i))
SELECT round(g.w, 3) AS w, {sql_sig('avg(power(lin.y3 - (g.w * lin.p3 + (1 - g.w) * (greatest(lin.p2, 1e-9) / greatest(lin.p1, 1e-9))), 2))', 8)} AS mse_si
FROM g CROSS JOIN lin GROUP BY g.w"""


@register("ratio_blend_grid", _GRID_SQL)
def ratio_blend_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17: 41-point grid of the SI ratio blend, MSE per weight from three moments."""
    o = assay_oof(spark, sf_dir).filter(F.col("model") == "m_lin")
    wide = o.groupBy(ID).agg(*[F.max(F.when(F.col("target") == t, F.col("pred"))).alias(f"p{i}") for i, t in enumerate(TARGETS, 1)],
                             F.max(F.when(F.col("target") == "t3", F.col("y"))).alias("y3"))
    grid = blend.ratio_blend_grid(wide, "p3", "p1", "p2", "y3")
    df = spark.createDataFrame(grid, "w double, mse_si double")
    return df.select(F.round("w", 3).alias("w"), sig(F.col("mse_si"), 8).alias("mse_si"))


@register("blend_search")
def blend_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirichlet weight search from per-target error Gram matrices."""
    lin = _fitted_oof(spark, sf_dir)
    names = list(models.LINEAR)
    moms = blend.error_moments(lin, TARGETS, names)
    w, score, parts = blend.blend_search(moms, TARGETS, 100, SEED)
    rows = [(t, m, float(w[t][j]), float(parts[t]), float(score)) for t in TARGETS for j, m in enumerate(names)]
    df = spark.createDataFrame(rows, "target string, model string, weight double, rmse double, score double")
    return df.select("target", "model", sig(F.col("weight"), 8).alias("weight"), sig(F.col("rmse"), 8).alias("rmse"),
                     sig(F.col("score"), 8).alias("score"))


@register("pca_scores")
def pca_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PC1 / PC2 scores of every embedding row (standardised, 0-filled,
    centred; sign fixed by the largest loading)."""
    wide, model = _embedding_pca(spark, sf_dir)
    return model.transform(wide, 2).select(ID, "label", "pc1", "pc2")


_SCATTER_SQL = f"""SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(index) AS BIGINT) AS sum_index, {sql_sig('avg(t3)', 9)} AS mean_colour,
       0.0::DOUBLE AS pc_mean, 0.0::DOUBLE AS pc_corr, 0.0::DOUBLE AS ic_mean, 1.0::DOUBLE AS ic_var_min, 1.0::DOUBLE AS ic_var_max, 0.0::DOUBLE AS ic_corr
FROM ({views.ASSAY_SQL}) a WHERE NOT is_test"""


def scatter_table(df: DataFrame, columns, colour: str, components: int = 3, seed: int = SEED) -> DataFrame:
    """Id, colour column, PC1, PC2 and the independent components of every row."""
    pca = decompose.fit_pca(df, columns)
    model = decompose.fit_ica(df, columns, components, seed, pca=pca)
    scored = model.transform(pca.transform(df.select(ID, colour, *[c for c in columns if c != colour]), 2))
    return scored.select(ID, F.col(colour).alias("colour"), "pc1", "pc2", *[f"ic{i + 1}" for i in range(len(model.unmixing))])


@register("component_scatter", _SCATTER_SQL)
def component_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + M9 + D11: the scatter table of the training rows coloured by t3, as what must hold of it:
    centred scores, uncorrelated components of unit variance."""
    tr = cut_lineage(views.train_part(assay_features(spark, sf_dir)))
    t = scatter_table(tr, FEATURES, "t3")
    ics = [c for c in t.columns if c.startswith("ic")]
    near = lambda e: F.round(e, 6) + F.lit(0.0)
    pairs = [F.abs(F.corr(a, b)) for k, a in enumerate(ics) for b in ics[k + 1:]]
    return t.agg(
        F.count(F.lit(1)).alias("n"), F.sum(ID).alias("sum_index"), sig(F.avg("colour"), 9).alias("mean_colour"),
        near(F.greatest(F.abs(F.avg("pc1")), F.abs(F.avg("pc2")))).alias("pc_mean"), near(F.abs(F.corr("pc1", "pc2"))).alias("pc_corr"),
        near(F.greatest(*[F.abs(F.avg(c)) for c in ics])).alias("ic_mean"), near(F.least(*[F.var_pop(c) for c in ics])).alias("ic_var_min"),
        near(F.greatest(*[F.var_pop(c) for c in ics])).alias("ic_var_max"), near(F.greatest(*pairs)).alias("ic_corr"))


# ---------------------------------------------------------------- value checks of the model half
_RIDGE_ONE_SQL = f"""WITH {_cte()}, tr AS (SELECT sum_qty, ln(1 + greatest(t1, 0)) AS y FROM af WHERE NOT is_test),
md AS (SELECT median(sum_qty) AS m FROM tr), x0 AS (SELECT coalesce(sum_qty, m) AS x, y FROM tr, md),
st AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, count(*) AS n FROM x0),
z AS (SELECT (x - mx) / sx AS z, y - my AS y FROM x0, st), s AS (SELECT sum(z * z) AS zz, sum(z * y) AS zy FROM z),
g AS (SELECT i, power(10.0::DOUBLE, -4.0 + i / 3.0) AS alpha FROM range(25) t(i)),
l AS (SELECT i, alpha, sum(power((y - z * zy / (zz + alpha)) / (1 - 1.0 / n - z * z / (zz + alpha)), 2)) AS sse FROM g, s, z, st GROUP BY i, alpha)
SELECT {sql_sig('alpha', 8)} AS alpha, {sql_sig('zy / (zz + alpha) / sx', 8)} AS slope, {sql_sig('my - mx * zy / (zz + alpha) / sx', 8)} AS intercept
FROM l, s, st ORDER BY sse, i LIMIT 1"""


@register("ridge_one_feature", _RIDGE_ONE_SQL)
def ridge_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 on one feature, where SQL can say all of it: imputation, standardisation, leave-one-out error of 25 penalties, coefficients."""
    tr = fold_frame(spark, sf_dir)
    full = prep.fit(tr, features=["sum_qty"])
    cfg = oof.OOFConfig(k=K, seed=SEED)
    fits, centre = oof.fit_linear(tr, ["sum_qty"], [("t1", True)], full, {}, cfg, scopes=[ALL], want=("ridge",))
    beta = fits[0].beta  # over [x - centre | missing | 1]
    df = spark.createDataFrame([(float(fits[0].info["alpha"]), float(beta[0]), float(beta[2] - beta[0] * centre[0]))], "alpha double, slope double, intercept double")
    return df.select(*[sig(F.col(c), 8).alias(c) for c in df.columns])


_BLEND_TRIALS = 20


def _dirichlet_rows(n_models: int) -> list[tuple[int, str, int, float]]:
    """The weights that the search draws: (trial, target, model, weight), a draw per target in order."""
    rng = np.random.default_rng(SEED)
    return [(i, t, j, float(w)) for i in range(_BLEND_TRIALS) for t in TARGETS for j, w in enumerate(rng.dirichlet(np.ones(n_models)))]


def _blend_fixture_sql() -> str:
    names = ["m_lin", "m_mean"]
    values = ", ".join(f"({i}, '{t}', '{names[j]}', {w!r}::DOUBLE)" for i, t, j, w in _dirichlet_rows(2))
    return f"""WITH {_oof_sql()},
r AS (SELECT target, model, 1.0 / (sqrt(avg(power(y - pred, 2))) + 1e-8) AS inv FROM oof GROUP BY target, model),
d AS (SELECT * FROM (VALUES {values}) v(trial, target, model, weight)
      UNION ALL SELECT -1, target, model, inv / sum(inv) OVER (PARTITION BY target) FROM r),
p AS (SELECT d.trial, o.target, o."index", sum(d.weight * o.pred) AS pred, max(o.y) AS y FROM oof o JOIN d ON o.target = d.target AND o.model = d.model
      GROUP BY d.trial, o.target, o."index"),
e AS (SELECT trial, target, sqrt(avg(power(pred - y, 2))) AS rmse FROM p GROUP BY trial, target),
b AS (SELECT trial, avg(rmse) AS score FROM e GROUP BY trial ORDER BY score, trial LIMIT 1)
SELECT e.target, d.model, {sql_sig('d.weight', 8)} AS weight, {sql_sig('e.rmse', 8)} AS rmse, {sql_sig('b.score', 8)} AS score
FROM b JOIN e ON e.trial = b.trial JOIN d ON d.trial = b.trial AND d.target = e.target"""


@register("blend_search_fixture", _blend_fixture_sql())
def blend_search_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C18 on the OOF fixture: inverse-RMSE start and 20 Dirichlet draws, best weights and scores from error moments."""
    names = ["m_lin", "m_mean"]
    moms = blend.error_moments(cut_lineage(assay_oof(spark, sf_dir)), TARGETS, names)
    w, score, parts = blend.blend_search(moms, TARGETS, _BLEND_TRIALS, SEED)
    rows = [(t, m, float(w[t][j]), float(parts[t]), float(score)) for t in TARGETS for j, m in enumerate(names)]
    df = spark.createDataFrame(rows, "target string, model string, weight double, rmse double, score double")
    return df.select("target", "model", *[sig(F.col(c), 8).alias(c) for c in ("weight", "rmse", "score")])


_STUMP_FEATURES = ("n_lines", "f_mod7", "max_tax")


def _stump_sql() -> str:
    cells = " UNION ALL ".join(f"SELECT {k} AS k, '{c}' AS feature, coalesce({c}, (SELECT median({c}) FROM tr)) AS x, y FROM tr" for k, c in enumerate(_STUMP_FEATURES))
    return f"""WITH {_cte()}, tr AS (SELECT n_lines, f_mod7, max_tax, t1 AS y FROM af WHERE NOT is_test),
m AS (SELECT avg(y) AS base FROM tr), c AS ({cells}),
b AS (SELECT k, feature, x, count(*) AS n, sum(y - base) AS g FROM c, m GROUP BY k, feature, x),
u AS (SELECT k, feature, x, sum(n) OVER w AS n_left, sum(g) OVER w AS g_left, sum(n) OVER t AS n, sum(g) OVER t AS g FROM b
      WINDOW w AS (PARTITION BY k ORDER BY x), t AS (PARTITION BY k)),
q AS (SELECT *, power(g_left, 2) / (n_left + 1) + power(g - g_left, 2) / (n - n_left + 1) - power(g, 2) / (n + 1) AS gain FROM u WHERE n_left < n)
SELECT feature, x AS last_left, CAST(n_left AS BIGINT) AS n_left, CAST(n - n_left AS BIGINT) AS n_right,
       {sql_sig('base + g_left / (n_left + 1)', 6)} AS left_value, {sql_sig('base + (g - g_left) / (n - n_left + 1)', 6)} AS right_value
FROM q, m ORDER BY gain DESC, k, x LIMIT 1"""


@register("tree_stump", _stump_sql())
def tree_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split of one booster tree (L2 of 1) over three columns, where SQL can search it too."""
    tr = fold_frame(spark, sf_dir)
    full = prep.fit(tr, features=list(_STUMP_FEATURES))
    bins = binning.fit_bins(tr, list(_STUMP_FEATURES), ID)
    fit = forests.TreeFit("stump", 0, TreeParams("boost", trees=1, depth=1, l2=1.0), SEED, 0)
    table = forests.prepare(tr, bins, [F.lit(0)], [F.col("t1")], [[full.stats[c].median for c in _STUMP_FEATURES]], [fit], ID)
    model = forests.fit_models(table)
    tree = forests.unpack_trees(bytes(model.trees.first().trees))[0]
    j, cut = int(tree.feature[0]), int(tree.bin[0])
    left, right = (model.fits[0]["base"] + float(tree.value[int(tree.left[0]) + k]) for k in (0, 1))
    scored = tr.select(F.coalesce(F.col(_STUMP_FEATURES[j]), F.lit(full.stats[_STUMP_FEATURES[j]].median)).alias("x"))
    at = F.lit(float(bins.cuts[j][cut]))
    return scored.agg(F.max(F.when(F.col("x") <= at, F.col("x"))).alias("last_left"), F.count_if(F.col("x") <= at).alias("n_left"),
                      F.count_if(F.col("x") > at).alias("n_right")).select(
        F.lit(_STUMP_FEATURES[j]).alias("feature"), "last_left", "n_left", "n_right", sig(F.lit(left), 6).alias("left_value"),
        sig(F.lit(right), 6).alias("right_value"))
