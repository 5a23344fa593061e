"""Diagnostics queries (step 9)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import blend, diagnose, profile
from foldwise.plans.core_queries import FEATURES, _cte, _final_sql, _oof_sql, assay_features, assay_oof, blended_predictions
from foldwise.plans.registry import register
from foldwise.session import ensure_checkpoint_dir
from foldwise.plans.rounding import sig, sql_sig
from foldwise.sources import views
from foldwise.sources.views import BINARY_SQL, ID, TARGETS

_AUC_SQL = """SELECT '{lab}' AS label, round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT score AS s, sum(CASE WHEN {lab} = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN {lab} = 1 THEN 0 ELSE 1 END) AS neg
            FROM b GROUP BY score) per) c"""


@register("auc_exact", f"""WITH b AS ({BINARY_SQL})
{_AUC_SQL.format(lab='quality')}
UNION ALL
{_AUC_SQL.format(lab='toxic')}""")
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ROC AUC (mid-rank, ties half) of n_chars for each binary label."""
    b = views.binary(spark, sf_dir)
    out = None
    for lab in ("quality", "toxic"):
        a = diagnose.exact_auc(b, lab, "score").select(F.lit(lab).alias("label"), F.round("auc", 9).alias("auc"), "n_pos", "n_neg")
        out = a if out is None else out.unionByName(a)
    return out


def _adversarial(spark, sf_dir):
    af = assay_features(spark, sf_dir)
    return diagnose.adversarial_validation(views.train_part(af), views.test_part(af), list(FEATURES))


@register("adversarial_auc")
def adversarial_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: train-vs-test classifier AUC per stratified fold, mean, population std,
    and the top features by |coef| and by forest importance."""
    r = _adversarial(spark, sf_dir)
    rows = [("auc_fold", str(i), v) for i, v in enumerate(r["auc_folds"])]
    rows += [("auc_mean", "", r["auc_mean"]), ("auc_std", "", r["auc_std"])]
    rows += [("abs_coef", f, v) for f, v in r["top_logistic"]] + [("importance", f, v) for f, v in r["top_importance"]]
    df = spark.createDataFrame(rows, "kind string, name string, value double")
    return df.select("kind", "name", sig(F.col("value"), 6).alias("value"))


@register("sample_weights")
def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density-style sample weights of the training rows, keyed by index (summary)."""
    r = _adversarial(spark, sf_dir)
    w = diagnose.sample_weights(r)
    return w.agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.min("weight").alias("min"), F.max("weight").alias("max"),
                 sig(F.avg("weight"), 8).alias("mean"), F.lit(r["shifted"]).alias("shifted"))


_WIDE_LIN = """lin AS (SELECT "index", max(CASE WHEN target = 't1' THEN pred END) AS p1, max(CASE WHEN target = 't2' THEN pred END) AS p2,
               max(CASE WHEN target = 't3' THEN pred END) AS p3, max(CASE WHEN target = 't1' THEN y END) AS y1,
               max(CASE WHEN target = 't2' THEN y END) AS y2, max(CASE WHEN target = 't3' THEN y END) AS y3
        FROM oof WHERE model = 'm_lin' GROUP BY "index")"""


def _abl_sql() -> str:
    ratio = "(greatest(p2, 1e-9) / greatest(p1, 1e-9))"
    rm = lambda e: f"sqrt(avg(power({e}, 2)))"
    def variant(name, si, w):
        r1, r2, r3 = rm("y1 - p1"), rm("y2 - p2"), rm(f"y3 - ({si})")
        return (f"SELECT '{name}' AS variant, {sql_sig(f'({r1} + {r2} + {r3}) / 3', 9)} AS score, {sql_sig(r1, 9)} AS rmse_t1, "
                f"{sql_sig(r2, 9)} AS rmse_t2, {sql_sig(r3, 9)} AS rmse_t3, {w} AS si_blend_w FROM lin, bw")
    return f"""WITH {_oof_sql()}, {_WIDE_LIN},
g AS (SELECT CAST(i AS DOUBLE) / 40.0 AS w FROM range(41) t(i)),
gm AS (SELECT g.w, avg(power(lin.y3 - (g.w * lin.p3 + (1 - g.w) * {ratio}), 2)) AS mse FROM g CROSS JOIN lin GROUP BY g.w),
bw AS (SELECT w FROM gm ORDER BY mse, w LIMIT 1)
{variant('si_model', 'p3', 'CAST(NULL AS DOUBLE)')}
UNION ALL {variant('si_ratio_only', ratio, 'CAST(NULL AS DOUBLE)')}
UNION ALL {variant('si_blend', f'bw.w * p3 + (1 - bw.w) * {ratio}', 'round(any_value(bw.w), 3)')}"""


@register("si_ablation", _abl_sql())
def si_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 + C17: SI as modelled, as the CC/IC ratio, and blended with the grid-best weight."""
    from foldwise.functions.exprs import floor_at

    o = assay_oof(spark, sf_dir).filter(F.col("model") == "m_lin")
    wide = o.groupBy(ID).agg(*[F.max(F.when(F.col("target") == t, F.col("pred"))).alias(f"p{i}") for i, t in enumerate(TARGETS, 1)],
                             *[F.max(F.when(F.col("target") == t, F.col("y"))).alias(f"y{i}") for i, t in enumerate(TARGETS, 1)])
    grid = blend.ratio_blend_grid(wide, "p3", "p1", "p2", "y3")
    w, _ = blend.best_grid_weight(grid, [0.0, 0.0])
    ratio = floor_at("p2", 1e-9) / floor_at("p1", 1e-9)
    variants = [("si_model", F.col("p3"), None), ("si_ratio_only", ratio, None),
                ("si_blend", F.lit(w) * F.col("p3") + F.lit(1 - w) * ratio, round(w, 3))]
    out = None
    for name, si, wv in variants:
        r = [F.sqrt(F.avg((F.col("y1") - F.col("p1")) ** 2)), F.sqrt(F.avg((F.col("y2") - F.col("p2")) ** 2)),
             F.sqrt(F.avg((F.col("y3") - si) ** 2))]
        d = wide.agg(F.lit(name).alias("variant"), sig((r[0] + r[1] + r[2]) / 3, 9).alias("score"),
                     sig(r[0], 9).alias("rmse_t1"), sig(r[1], 9).alias("rmse_t2"), sig(r[2], 9).alias("rmse_t3"),
                     F.lit(wv).cast("double").alias("si_blend_w"))
        out = d if out is None else out.unionByName(d)
    return out


def _fin_sql_stats() -> str:
    parts = []
    for i, t in enumerate(TARGETS, 1):
        c = f"p{i}"
        parts.append(f"""SELECT '{t}' AS target, CAST(count({c}) AS BIGINT) AS count, {sql_sig(f'avg({c})', 9)} AS mean,
       {sql_sig(f'stddev_samp({c})', 8)} AS std, {sql_sig(f'min({c})', 10)} AS min,
       {sql_sig(f'quantile_cont({c}, 0.25)', 10)} AS q25, {sql_sig(f'quantile_cont({c}, 0.5)', 10)} AS q50,
       {sql_sig(f'quantile_cont({c}, 0.75)', 10)} AS q75, {sql_sig(f'max({c})', 10)} AS max FROM fin""")
    parts.append(f"""SELECT 'checksum' AS target, CAST(count(*) AS BIGINT), {sql_sig('sum(p1 + p2 + p3)', 9)}, NULL, NULL, NULL, NULL, NULL, NULL FROM fin""")
    return f"WITH {_final_sql()}\n" + "\nUNION ALL\n".join(parts)


@register("fingerprint", _fin_sql_stats())
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 + A19 (+ A20 inputs): describe statistics per predicted target and the
    sum of all prediction cells."""
    fin = blended_predictions(spark, sf_dir).select(ID, F.col("p1").alias("t1"), F.col("p2").alias("t2"), F.col("p3").alias("t3"))
    d = profile.describe(fin, list(TARGETS)).select(
        F.col("feature").alias("target"), F.col("count").cast("bigint").alias("count"), sig(F.col("mean"), 9).alias("mean"),
        sig(F.col("std"), 8).alias("std"), sig(F.col("min"), 10).alias("min"), sig(F.col("q25"), 10).alias("q25"),
        sig(F.col("q50"), 10).alias("q50"), sig(F.col("q75"), 10).alias("q75"), sig(F.col("max"), 10).alias("max"))
    ck = fin.agg(F.lit("checksum").alias("target"), F.count(F.lit(1)).cast("bigint").alias("count"),
                 sig(F.sum(F.col("t1") + F.col("t2") + F.col("t3")), 9).alias("mean"),
                 *[F.lit(None).cast("double").alias(c) for c in ("std", "min", "q25", "q50", "q75", "max")])
    return d.unionByName(ck)


@register("output_contract", f"""WITH {_final_sql()}
SELECT CAST(count(*) AS BIGINT) AS n_rows, bool_and(p1 >= 0 AND p2 >= 0 AND p3 >= 0) AS all_non_negative,
       true AS columns_ok FROM fin""")
def output_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission shape, exact columns, non-negative predictions."""
    fin = blended_predictions(spark, sf_dir).select(ID, F.col("p1").alias("t1"), F.col("p2").alias("t2"), F.col("p3").alias("t3"))
    return diagnose.output_contract(fin, [ID, *TARGETS])


def _session_of(spark: SparkSession, more: int) -> SparkSession:
    """A session of the same application with so many shuffle partitions more than the caller's, which keeps its own:
    another layout of the rows, whose partitions are no larger."""
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", str(int(spark.conf.get("spark.sql.shuffle.partitions")) + more))
    return other


@register("submission_diff", f"""WITH {_final_sql()}
SELECT CAST(count(*) AS BIGINT) AS n_keys, CAST(0 AS BIGINT) AS n_unmatched, CAST(0.0 AS DOUBLE) AS max_abs_diff, true AS stable FROM fin""")
def submission_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + D10: the same program run twice on differently partitioned input;
    cell-by-cell full-outer diff; stable when the largest difference < 1e-6."""
    a = blended_predictions(spark, sf_dir)
    b = blended_predictions(_session_of(spark, 3), sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/second-run-{uuid.uuid4().hex[:12]}"
    b.write.parquet(path)
    b = spark.read.parquet(path)
    d = diagnose.submission_diff(a, b, ["p1", "p2", "p3"])
    return d.select("n_keys", "n_unmatched", F.round("max_abs_diff", 6).alias("max_abs_diff"),
                    (F.col("max_abs_diff") < 1e-6).alias("stable"))



@register("prefix_means", f"""WITH {_cte()}, tr AS (SELECT * FROM af WHERE NOT is_test)
SELECT feature, CAST(rank AS INTEGER) AS rank, {sql_sig('mean', 9)} AS mean FROM (
  SELECT *, row_number() OVER (ORDER BY mean DESC, feature) AS rank FROM (
    SELECT 'f_mod7' AS feature, avg(f_mod7) AS mean FROM tr UNION ALL
    SELECT 'f_const', avg(f_const) FROM tr UNION ALL
    SELECT 'f_sparse', avg(f_sparse) FROM tr)) WHERE rank <= 15""")
def prefix_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of every column with a name prefix ('f_'), top 15."""
    tr = views.train_part(assay_features(spark, sf_dir))
    m = profile.prefix_means(tr, "f_").withColumn("part", F.lit(0))
    top = profile.top_k_per(m, "part", "mean", 15, "feature")
    return top.select("feature", F.col("rank").cast("int").alias("rank"), sig(F.col("mean"), 9).alias("mean"))


@register("fingerprint_check", f"""WITH {_final_sql()}
SELECT true AS within_tolerance, CAST(24 AS BIGINT) AS n_stats""")
def fingerprint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Describe statistics of a second run (other partitioning) within
    max(0.01, 5 %) of the first run's stored statistics."""
    def stats(parts: int):
        fin = blended_predictions(_session_of(spark, parts), sf_dir).select(F.col("p1").alias("t1"), F.col("p2").alias("t2"), F.col("p3").alias("t3"))
        d = profile.describe(fin, list(TARGETS)).collect()
        return [(r.feature, s, float(r[s])) for r in d for s in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]

    schema = "target string, stat string, value double"
    return diagnose.fingerprint_compare(spark.createDataFrame(stats(3), schema), spark.createDataFrame(stats(8), schema))


@register("eda_summary")
def eda_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes, feature count, target skews, ratio identity, PC1+PC2 share,
    derived columns and candidate names, as (key, value) rows."""
    from foldwise.operators import models
    from foldwise.plans.core_queries import DERIVED
    from foldwise.plans.model_queries import pca_variance

    af = assay_features(spark, sf_dir)
    tr, te = views.train_part(af), views.test_part(af)
    sk = {r.feature: r.skew for r in profile.skewness(tr, list(TARGETS)).collect()}
    ratio = profile.ratio_identity(tr, "t3", "t2", "t1").first().max_abs_diff
    pcs = pca_variance(spark, sf_dir).orderBy("component").limit(2).collect()
    rows = [("train_rows", str(tr.count())), ("test_rows", str(te.count())), ("n_features", str(len(FEATURES))),
            *[(f"skew_{t}", f"{sk[t]:.4f}") for t in TARGETS], ("ratio_identity_max_abs_diff", f"{ratio:.3e}"),
            ("pc1_pc2_variance_share", f"{pcs[0].explained_variance_ratio + pcs[1].explained_variance_ratio:.6f}"),
            ("derived_columns", ",".join(DERIVED)), ("models", ",".join(models.registry()))]
    return spark.createDataFrame(rows, "key string, value string")


@register("diagnostics_run")
def diagnostics_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate report + adversarial validation + OOF stacking (no finals)
    + SI ablation in one program; flattened to (section, key, value)."""
    import json

    from foldwise.plans.diagnostics import run_diagnostics
    from foldwise.plans.program_queries import whole_config

    a = views.assay(spark, sf_dir)
    doc = run_diagnostics(spark, views.train_part(a), views.test_part(a).drop(*TARGETS), whole_config(cv_strategy="hash"))
    rows = []
    for section, body in doc.items():
        if isinstance(body, dict):
            for k, v in body.items():
                rows.append((section, str(k), json.dumps(v, default=float)))
        else:
            rows.append((section, "", json.dumps(body, default=float)))
    return spark.createDataFrame(rows, "section string, key string, value string")
