"""Scan, features, preprocessing, scores and blends on the assay view (steps 0-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.exprs import TARGET_FLOOR, floor_at, ratio_blend, stable_hash
from foldwise.functions.features import add_domain_features
from foldwise.operators import metrics, prep
from foldwise.operators.fixtures import linear_oof
from foldwise.plans.registry import register
from foldwise.plans.rounding import sig, sql_sig
from foldwise.sources import views
from foldwise.sources.views import ASSAY_ROLES, ASSAY_SQL, ID, TARGETS

DERIVED_SQL = """sum_qty / (avg_price + 1e-6) AS LogP_TPSA,
       avg_disc + max_tax AS Charge_sum,
       CASE WHEN f_mod7 > 0 THEN 1.0 ELSE 0.0 END AS fr_imide_flag,
       n_lines * sum_qty AS Ring_LogP,
       acctbal * sum_qty AS FractionCSP3_LogP"""
DERIVED = ("LogP_TPSA", "Charge_sum", "fr_imide_flag", "Ring_LogP", "FractionCSP3_LogP")
BASE = ("n_lines", "sum_qty", "avg_price", "avg_disc", "max_tax", "f_mod7", "acctbal", "f_const", "f_sparse")
FEATURES = BASE + DERIVED
BLEND_W = 0.5  # SI ratio-blend weight used by the flagship


def assay_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_domain_features(views.assay(spark, sf_dir), ASSAY_ROLES)


def _cte() -> str:
    return f"a AS ({ASSAY_SQL}), af AS (SELECT *, {DERIVED_SQL} FROM a)"


# ---------------------------------------------------------------- S1 / V1
@register("scan_assay", f"""
SELECT "index", n_lines, sum_qty, round(avg_price, 6) AS avg_price, round(avg_disc, 8) AS avg_disc,
       max_tax, f_mod7, acctbal, f_const, f_sparse, is_test, t1, round(t2, 4) AS t2, round(t3, 8) AS t3
FROM ({ASSAY_SQL}) a""")
def scan_assay(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = views.assay(spark, sf_dir)
    return a.withColumns({
        "avg_price": F.round("avg_price", 6), "avg_disc": F.round("avg_disc", 8),
        "t2": F.round("t2", 4), "t3": F.round("t3", 8),
    })


# ---------------------------------------------------------------- A21 digest
#: digested columns and the scale that makes them integers; the offset keeps averages of a few cents off the rounding ties,
#: where the last bit of a sum would decide
DIGEST_OFFSET = 0.013
DIGEST_SCALE = {"n_lines": 100, "sum_qty": 100, "avg_price": 100, "avg_disc": 10_000, "max_tax": 100, "f_mod7": 100,
                "acctbal": 100, "f_const": 100, "f_sparse": 100, "t1": 100, "t2": 100, "t3": 10_000}
_DIGEST_PARTS = ", ".join(f"coalesce(CAST(CAST(round({c} * {k} + {DIGEST_OFFSET}) AS BIGINT) AS VARCHAR), '')" for c, k in DIGEST_SCALE.items())


@register("table_digest", f"""
WITH a AS ({ASSAY_SQL})
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(('0x' || substr(md5(concat_ws('|', CAST("index" AS VARCHAR), CAST(is_test AS VARCHAR),
            {_DIGEST_PARTS}) || ':7'), 1, 8))::BIGINT) AS VARCHAR) AS digest
FROM a""")
def table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-insensitive digest of all columns: count and sum of a per-row hash of
    the row's values scaled to integers (text of integers is identical in every
    engine).  The sum is a decimal, as text: it has no overflow at any row count."""
    a = views.assay(spark, sf_dir)
    parts = [F.col(ID).cast("string"), F.col("is_test").cast("string")] + [
        F.coalesce(F.round(F.col(c) * k + F.lit(DIGEST_OFFSET)).cast("bigint").cast("string"), F.lit("")) for c, k in DIGEST_SCALE.items()
    ]
    return a.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(stable_hash(F.concat_ws("|", *parts), 7).cast("decimal(20,0)")).cast("string").alias("digest"),
    )


# ---------------------------------------------------------------- P3-P8
@register("derive_features", f"""
WITH {_cte()}
SELECT "index", {', '.join(f'{sql_sig(c, 9)} AS {c}' for c in DERIVED)} FROM af""")
def derive_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = assay_features(spark, sf_dir)
    return df.select(ID, *[sig(F.col(c), 9).alias(c) for c in DERIVED])


# ---------------------------------------------------------------- M1 stats
def _prep_stats_sql(where: str = "WHERE NOT is_test") -> str:
    parts = []
    for c in FEATURES:
        parts.append(f"""SELECT '{c}' AS feature,
  avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_ratio,
  median({c}) AS median,
  avg(coalesce({c}, m)) AS mean,
  stddev_pop(coalesce({c}, m)) AS std,
  var_samp(coalesce({c}, m)) AS var_samp
FROM tr, (SELECT median({c}) AS m FROM tr) mm""")
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH {_cte()}, tr AS (SELECT * FROM af {where}),
s AS ({body})
SELECT feature, round(missing_ratio, 9) AS missing_ratio, {sql_sig('median', 9)} AS median,
       {sql_sig('mean', 8)} AS mean, {sql_sig('std', 7)} AS std, {sql_sig('var_samp', 6)} AS var_samp,
       NOT (missing_ratio > 0.3 OR var_samp <= 1e-12) AS kept
FROM s"""


@register("prep_stats", _prep_stats_sql())
def prep_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr = views.train_part(assay_features(spark, sf_dir))
    model = prep.fit(tr, features=FEATURES)
    st = model.stats_frame(spark)
    return st.select(
        "feature", F.round("missing_ratio", 9).alias("missing_ratio"), sig(F.col("median"), 9).alias("median"),
        sig(F.col("mean"), 8).alias("mean"), sig(F.col("std"), 7).alias("std"), sig(F.col("var_samp"), 6).alias("var_samp"),
        "kept",
    )


# ---------------------------------------------------------------- M4 transform
def _prep_transform_sql() -> str:
    kept = ("n_lines", "sum_qty", "avg_price", "avg_disc", "max_tax", "f_mod7", "acctbal") + DERIVED
    stats = ",\n".join(
        f"(SELECT median({c}) FROM tr) AS m_{c}, (SELECT avg(coalesce({c}, (SELECT median({c}) FROM tr))) FROM tr) AS mu_{c}, "
        f"(SELECT CASE WHEN stddev_pop(coalesce({c}, (SELECT median({c}) FROM tr))) > 2.220446049250313e-15 "
        f"THEN stddev_pop(coalesce({c}, (SELECT median({c}) FROM tr))) ELSE 1.0 END FROM tr) AS sd_{c}"
        for c in kept
    )
    cols = ", ".join(f"round((coalesce(te.{c}, st.m_{c}) - st.mu_{c}) / st.sd_{c}, 4) AS {c}" for c in kept)
    return f"""WITH {_cte()}, tr AS (SELECT * FROM af WHERE NOT is_test), te AS (SELECT * FROM af WHERE is_test),
st AS (SELECT {stats})
SELECT te."index", {cols} FROM te, st"""


@register("prep_transform", _prep_transform_sql())
def prep_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train part, apply to the test part: one projection, no shuffle."""
    af = assay_features(spark, sf_dir)
    model = prep.fit(views.train_part(af), features=FEATURES)
    out = model.transform(views.test_part(af), keep=[ID])
    return out.select(ID, *[F.round(F.col(c), 4).alias(c) for c in model.features])


# ---------------------------------------------------------------- V5 OOF + scores
def _oof_sql() -> str:
    return f"""a AS ({ASSAY_SQL}),
tr AS (SELECT "index", CAST("index" % 5 AS INTEGER) AS fold, sum_qty AS x, t1, t2, t3 FROM a WHERE NOT is_test),
lt AS (SELECT "index", fold, x, 't1' AS target, t1 AS y FROM tr
       UNION ALL SELECT "index", fold, x, 't2', t2 FROM tr
       UNION ALL SELECT "index", fold, x, 't3', t3 FROM tr),
fl AS (SELECT DISTINCT fold FROM tr),
med AS (SELECT fl.fold, median(tr.x) AS x_fill FROM fl JOIN tr ON tr.fold <> fl.fold GROUP BY fl.fold),
par AS (SELECT fl.fold, lt.target, avg(lt.y) AS mean_y,
               regr_slope(lt.y, coalesce(lt.x, med.x_fill)) AS slope,
               regr_intercept(lt.y, coalesce(lt.x, med.x_fill)) AS intercept, any_value(med.x_fill) AS x_fill
        FROM fl JOIN med ON med.fold = fl.fold JOIN lt ON lt.fold <> fl.fold GROUP BY fl.fold, lt.target),
oof AS (SELECT lt."index", lt.target, 'm_mean' AS model, lt.fold, lt.y, par.mean_y AS pred
        FROM lt JOIN par ON par.fold = lt.fold AND par.target = lt.target
        UNION ALL
        SELECT lt."index", lt.target, 'm_lin' AS model, lt.fold, lt.y, par.intercept + par.slope * coalesce(lt.x, par.x_fill) AS pred
        FROM lt JOIN par ON par.fold = lt.fold AND par.target = lt.target)"""


def assay_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OOF table is the materialisation point of every second-level query:
    cut the lineage (checkpoint into the shared folder) so weights, blends and
    scores read it once instead of re-deriving the joins."""
    return linear_oof(views.train_part(views.assay(spark, sf_dir)))


@register("oof_fixture", f"""WITH {_oof_sql()}
SELECT target, model, fold, CAST(count(*) AS BIGINT) AS n, {sql_sig('sum(pred)', 8)} AS sum_pred,
       {sql_sig('min(pred)', 8)} AS min_pred, {sql_sig('max(pred)', 8)} AS max_pred
FROM oof GROUP BY target, model, fold""")
def oof_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    oof = assay_oof(spark, sf_dir)
    return oof.groupBy("target", "model", "fold").agg(
        F.count(F.lit(1)).alias("n"), sig(F.sum("pred"), 8).alias("sum_pred"),
        sig(F.min("pred"), 8).alias("min_pred"), sig(F.max("pred"), 8).alias("max_pred"),
    )


@register("rmse_score", f"""WITH {_oof_sql()},
r AS (SELECT target, model, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM oof GROUP BY target, model)
SELECT model, {sql_sig('avg(rmse)', 9)} AS score, CAST(count(*) AS BIGINT) AS n_targets,
       {sql_sig("max(CASE WHEN target = 't1' THEN rmse END)", 9)} AS rmse_t1,
       {sql_sig("max(CASE WHEN target = 't2' THEN rmse END)", 9)} AS rmse_t2,
       {sql_sig("max(CASE WHEN target = 't3' THEN rmse END)", 9)} AS rmse_t3
FROM r GROUP BY model""")
def rmse_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A6: per-target RMSE and the mean over targets, per model."""
    r = metrics.rmse_by(assay_oof(spark, sf_dir), ["target", "model"])
    return r.groupBy("model").agg(
        sig(F.avg("rmse"), 9).alias("score"), F.count(F.lit(1)).alias("n_targets"),
        *[sig(F.max(F.when(F.col("target") == t, F.col("rmse"))), 9).alias(f"rmse_{t}") for t in TARGETS],
    )


@register("mean_fold_rmse", f"""WITH {_oof_sql()},
r AS (SELECT target, model, fold, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM oof GROUP BY target, model, fold)
SELECT target, model, {sql_sig('avg(rmse)', 9)} AS mean_fold_rmse, CAST(count(*) AS BIGINT) AS n_folds
FROM r GROUP BY target, model""")
def mean_fold_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unweighted mean over folds of the fold RMSE."""
    r = metrics.mean_fold_rmse(assay_oof(spark, sf_dir))
    return r.select("target", "model", sig(F.col("mean_fold_rmse"), 9).alias("mean_fold_rmse"), "n_folds")


_WEIGHTS_SQL = """w AS (SELECT target, model, rmse, (1.0 / (rmse + 1e-8)) / sum(1.0 / (rmse + 1e-8)) OVER (PARTITION BY target) AS weight
      FROM (SELECT target, model, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM oof GROUP BY target, model) r)"""


@register("inverse_rmse_weights", f"""WITH {_oof_sql()}, {_WEIGHTS_SQL}
SELECT target, model, {sql_sig('rmse', 9)} AS rmse, {sql_sig('weight', 9)} AS weight FROM w""")
def inverse_rmse_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = metrics.inverse_rmse_weights(assay_oof(spark, sf_dir))
    return w.select("target", "model", sig(F.col("rmse"), 9).alias("rmse"), sig(F.col("weight"), 9).alias("weight"))


@register("weighted_ensemble", f"""WITH {_oof_sql()},
wt AS (SELECT * FROM (VALUES ('t1', 'm_mean', 1.0), ('t1', 'm_lin', 3.0), ('t2', 'm_lin', 2.0)) v(target, model, weight)),
e AS (SELECT oof."index", oof.target, any_value(oof.y) AS y,
             sum(coalesce(wt.weight, 1.0) * oof.pred) / sum(coalesce(wt.weight, 1.0)) AS pred
      FROM oof LEFT JOIN wt ON wt.target = oof.target AND wt.model = oof.model GROUP BY oof."index", oof.target)
SELECT target, CAST(count(*) AS BIGINT) AS n, {sql_sig('sqrt(avg((y - pred) * (y - pred)))', 9)} AS rmse,
       {sql_sig('sum(pred)', 8)} AS sum_pred FROM e GROUP BY target""")
def weighted_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted mean with partial weight sets (a missing weight counts 1.0; t3 has none)."""
    oof = assay_oof(spark, sf_dir)
    wt = spark.createDataFrame([("t1", "m_mean", 1.0), ("t1", "m_lin", 3.0), ("t2", "m_lin", 2.0)],
                               "target string, model string, weight double")
    ys = oof.groupBy(ID, "target").agg(F.first("y").alias("y"))
    e = metrics.weighted_ensemble(oof, wt).join(ys, [ID, "target"])
    d = F.col("y") - F.col("pred")
    return e.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), sig(F.sqrt(F.avg(d * d)), 9).alias("rmse"), sig(F.sum("pred"), 8).alias("sum_pred")
    )


def _final_sql() -> str:
    return f"""{_oof_sql()}, {_WEIGHTS_SQL},
bl AS (SELECT oof."index", oof.target, any_value(oof.y) AS y, sum(w.weight * oof.pred) AS pred
       FROM oof JOIN w ON w.target = oof.target AND w.model = oof.model GROUP BY oof."index", oof.target),
wide AS (SELECT "index",
         max(CASE WHEN target = 't1' THEN pred END) AS p1, max(CASE WHEN target = 't2' THEN pred END) AS p2,
         max(CASE WHEN target = 't3' THEN pred END) AS p3,
         max(CASE WHEN target = 't1' THEN y END) AS y1, max(CASE WHEN target = 't2' THEN y END) AS y2,
         max(CASE WHEN target = 't3' THEN y END) AS y3
         FROM bl GROUP BY "index"),
pp AS (SELECT "index", greatest(p1, 1e-8) AS p1, greatest(p2, 1e-8) AS p2, greatest(p3, 0.0) AS p3, y1, y2, y3 FROM wide),
fin AS (SELECT "index", p1, p2, {BLEND_W} * p3 + {1 - BLEND_W} * (greatest(p2, 1e-8) / greatest(p1, 1e-8)) AS p3, y1, y2, y3 FROM pp)"""


def blended_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 -> A23 -> wide per index -> P15 floors -> P16 ratio blend.

    The weighted blend per (index, target) and the wide table per index are
    one aggregate: conditional weighted sums, one shuffle on the index."""
    oof = assay_oof(spark, sf_dir)
    weights = metrics.inverse_rmse_weights(oof).select("target", "model", "weight")   # #targets x #models rows
    scored = oof.join(F.broadcast(weights), ["target", "model"])
    wide = scored.groupBy(ID).agg(
        *[F.sum(F.when(F.col("target") == t, F.col("weight") * F.col("pred"))).alias(f"p{i}") for i, t in enumerate(TARGETS, 1)],
        *[F.max(F.when(F.col("target") == t, F.col("y"))).alias(f"y{i}") for i, t in enumerate(TARGETS, 1)],
    )
    pp = wide.select(
        ID, floor_at("p1", TARGET_FLOOR).alias("p1"), floor_at("p2", TARGET_FLOOR).alias("p2"),
        floor_at("p3", 0.0).alias("p3"), "y1", "y2", "y3",
    )
    return pp.withColumn("p3", ratio_blend("p3", "p1", "p2", BLEND_W))


@register("postprocess_blend", f"""WITH {_final_sql()}
SELECT "index", round(p1, 3) AS p1, round(p2, 3) AS p2, {sql_sig('p3', 9)} AS p3 FROM fin""")
def postprocess_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    fin = blended_predictions(spark, sf_dir)
    return fin.select(ID, F.round("p1", 3).alias("p1"), F.round("p2", 3).alias("p2"), sig(F.col("p3"), 9).alias("p3"))


SCORE_SQL = f"""WITH {_final_sql()},
r AS (SELECT 't1' AS target, count(*) AS n, sqrt(avg((y1 - p1) * (y1 - p1))) AS rmse FROM fin
      UNION ALL SELECT 't2', count(*), sqrt(avg((y2 - p2) * (y2 - p2))) FROM fin
      UNION ALL SELECT 't3', count(*), sqrt(avg((y3 - p3) * (y3 - p3))) FROM fin)
SELECT target, CAST(n AS BIGINT) AS n, {sql_sig('rmse', 9)} AS rmse FROM r
UNION ALL SELECT 'score', CAST(min(n) AS BIGINT), {sql_sig('avg(rmse)', 9)} FROM r"""


@register("score_by_target", SCORE_SQL)
def score_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: fold-complement OOF -> inverse-RMSE blend -> floors -> SI ratio blend
    -> RMSE per target and the competition score (mean over targets)."""
    fin = blended_predictions(spark, sf_dir)
    aggs = []
    for i, t in enumerate(TARGETS, 1):
        d = F.col(f"y{i}") - F.col(f"p{i}")
        aggs.append(F.sqrt(F.avg(d * d)).alias(t))
    one = fin.agg(F.count(F.lit(1)).alias("n"), *aggs)
    # one aggregate, four output rows (per target and their mean): no second branch
    rows = [F.struct(F.lit(t).alias("target"), F.col(t).alias("rmse")) for t in TARGETS]
    rows.append(F.struct(F.lit("score").alias("target"), (sum(F.col(t) for t in TARGETS) / len(TARGETS)).alias("rmse")))
    per = one.select("n", F.explode(F.array(*rows)).alias("r")).select(
        F.col("r.target").alias("target"), "n", F.col("r.rmse").alias("rmse"))
    return per.select("target", F.col("n").cast("bigint").alias("n"), sig(F.col("rmse"), 9).alias("rmse"))
