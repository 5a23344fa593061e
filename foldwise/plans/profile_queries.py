"""Profiling queries on the assay view (step 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import prep, profile
from foldwise.plans.core_queries import FEATURES, _cte, assay_features
from foldwise.plans.registry import register
from foldwise.plans.rounding import sig, sql_sig
from foldwise.sources import views
from foldwise.sources.views import TARGETS

PROFILE_COLS = FEATURES + TARGETS
TRAIN = "tr AS (SELECT * FROM af WHERE NOT is_test)"


def _train(spark, sf_dir):
    return views.train_part(assay_features(spark, sf_dir))


def _union(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


_MISS_TMPL = 'SELECT \'{c}\' AS "column", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_ratio FROM tr'


@register("missing_ratio_top", f"""WITH {_cte()}, {TRAIN},
m AS ({_union(_MISS_TMPL, PROFILE_COLS)})
SELECT "column", round(missing_ratio, 9) AS missing_ratio FROM m WHERE missing_ratio > 0
ORDER BY missing_ratio DESC, "column" LIMIT 10""")
def missing_ratio_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + T1: the ten largest non-zero missing ratios."""
    m = profile.missing_top(_train(spark, sf_dir), PROFILE_COLS, 10)
    return m.select("column", F.round("missing_ratio", 9).alias("missing_ratio"))


@register("describe", f"""WITH {_cte()}, {TRAIN}
{_union("SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS count, " + sql_sig('avg({c})', 9) + " AS mean, "
        + sql_sig('stddev_samp({c})', 8) + " AS std, min({c}) AS min, "
        + sql_sig('quantile_cont({c}, 0.25)', 10) + " AS q25, " + sql_sig('quantile_cont({c}, 0.5)', 10) + " AS q50, "
        + sql_sig('quantile_cont({c}, 0.75)', 10) + " AS q75, max({c}) AS max FROM tr", PROFILE_COLS)}""")
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, std, min, exact quartiles, max per column."""
    d = profile.describe(_train(spark, sf_dir), PROFILE_COLS)
    return d.select(
        "feature", F.col("count").cast("bigint").alias("count"), sig(F.col("mean"), 9).alias("mean"),
        sig(F.col("std"), 8).alias("std"), "min", sig(F.col("q25"), 10).alias("q25"),
        sig(F.col("q50"), 10).alias("q50"), sig(F.col("q75"), 10).alias("q75"), "max",
    )


@register("skew", f"""WITH {_cte()}, {TRAIN}
{_union("SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS n, " + sql_sig('skewness({c})', 7) + " AS skew FROM tr", PROFILE_COLS)}""")
def skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bias-adjusted skewness (pandas / DuckDB definition)."""
    s = profile.skewness(_train(spark, sf_dir), PROFILE_COLS)
    return s.select("feature", F.col("n").cast("bigint").alias("n"), sig(F.col("skew"), 7).alias("skew"))


def _sql_corr(a: str, b: str) -> str:
    """Correlation in SQL, NULL where a column is constant."""
    return f"(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END)"


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


@register("corr_matrix", f"""WITH {_cte()}, {TRAIN}
{chr(10).join(('UNION ALL ' if i else '') + f"SELECT '{a}' AS a, '{b}' AS b, {sql_sig(_sql_corr(a, b), 7)} AS corr FROM tr" for i, (a, b) in enumerate(_pairs(PROFILE_COLS)))}""")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair of columns."""
    c = profile.correlations(_train(spark, sf_dir), list(PROFILE_COLS))
    return c.select("a", "b", sig(F.col("corr"), 7).alias("corr"))


@register("corr_topk", f"""WITH {_cte()}, {TRAIN},
med AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in FEATURES)} FROM tr),
imp AS (SELECT {', '.join(f'coalesce(tr.{c}, med.m_{c}) AS {c}' for c in FEATURES)}, {', '.join(TARGETS)} FROM tr, med),
c AS ({chr(10).join(('UNION ALL ' if i else '') + f"SELECT '{t}' AS target, '{f}' AS feature, abs({_sql_corr(f, t)}) AS abs_corr FROM imp" for i, (t, f) in enumerate([(t, f) for t in TARGETS for f in FEATURES]))}),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs_corr DESC, feature) AS rank FROM c)
SELECT target, feature, CAST(rank AS INTEGER) AS rank, {sql_sig('abs_corr', 7)} AS abs_corr FROM r WHERE rank <= 10""")
def corr_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 + W2: top-10 |corr| with each target after median imputation."""
    tr = _train(spark, sf_dir)
    med = prep.fit(tr, features=FEATURES, missing_threshold=1.0)
    meds = {c: s.median for c, s in {**med.stats, **med.screened}.items()}
    imp = tr.select(*[F.coalesce(F.col(c), F.lit(meds[c])).alias(c) for c in FEATURES], *TARGETS)
    c = profile.correlation_pairs(imp, list(TARGETS), list(FEATURES)).select(
        F.col("a").alias("target"), F.col("b").alias("feature"), F.abs("corr").alias("abs_corr"))
    top = profile.top_k_per(c, "target", "abs_corr", 10, "feature")
    return top.select("target", "feature", F.col("rank").cast("int").alias("rank"), sig(F.col("abs_corr"), 7).alias("abs_corr"))


@register("mean_shift_topk", f"""WITH {_cte()},
s AS ({_union("SELECT '{c}' AS feature, abs(avg(CASE WHEN is_test THEN {c} END) - avg(CASE WHEN NOT is_test THEN {c} END)) / nullif(stddev_samp(CASE WHEN NOT is_test THEN {c} END), 0) AS shift FROM af", FEATURES)}),
r AS (SELECT *, row_number() OVER (ORDER BY shift DESC, feature) AS rank FROM s)
SELECT feature, CAST(rank AS INTEGER) AS rank, {sql_sig('shift', 6)} AS shift FROM r WHERE rank <= 15""")
def mean_shift_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """train/test mean shift in train-std units, 15 largest."""
    af = assay_features(spark, sf_dir)
    s = profile.mean_shift(views.train_part(af), views.test_part(af), list(FEATURES)).withColumn("part", F.lit(0))
    top = profile.top_k_per(s, "part", "shift", 15, "feature")
    return top.select("feature", F.col("rank").cast("int").alias("rank"), sig(F.col("shift"), 6).alias("shift"))


@register("nunique_flat", f"""WITH {_cte()}, {TRAIN},
u AS ({_union("SELECT '{c}' AS feature, CAST(count(DISTINCT {c} + 0.0) AS BIGINT) AS nunique FROM tr", FEATURES)})
SELECT feature, nunique, nunique <= 2 AS low_cardinality FROM u""")
def nunique_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: exact distinct count per column; flag those with at most two values."""
    u = profile.distinct_counts(_train(spark, sf_dir), FEATURES)
    grid = spark.createDataFrame([(c,) for c in FEATURES], "feature string")
    u = grid.join(u, "feature", "left").select("feature", F.coalesce(F.col("nunique"), F.lit(0)).cast("bigint").alias("nunique"))
    return u.withColumn("low_cardinality", F.col("nunique") <= 2)


@register("constant_features", f"""WITH {_cte()}, {TRAIN},
v AS ({_union("SELECT '{c}' AS feature, var_samp({c}) AS v FROM tr", FEATURES)})
SELECT feature FROM v WHERE v <= 0""")
def constant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose sample variance is zero."""
    tr = _train(spark, sf_dir)
    long = profile.long_form(tr, FEATURES)
    v = long.groupBy("feature").agg(F.var_samp("value").alias("v"))
    return v.filter(F.col("v") <= 0).select("feature")


_HIST_SQL = """h AS (SELECT min({c}) AS lo, max({c}) AS hi FROM tr),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / {b} ELSE 1.0 END AS width FROM h),
c AS (SELECT least(CAST(floor((tr.{c} - w.lo) / w.width) AS INTEGER), {b} - 1) AS bin, count(*) AS n
      FROM tr, w WHERE tr.{c} IS NOT NULL GROUP BY 1)
SELECT '{c}' AS "column", CAST(g.bin AS INTEGER) AS bin, round(w.lo + g.bin * w.width, 6) AS lo,
       round(w.lo + (g.bin + 1) * w.width, 6) AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range({b}) g(bin) CROSS JOIN w LEFT JOIN c ON c.bin = g.bin"""


@register("histogram", f"WITH {_cte()}, {TRAIN}, " + _HIST_SQL.format(c="t1", b=40))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 equal-width bins of t1, last bin closed, empty bins kept."""
    h = profile.histogram(_train(spark, sf_dir), "t1", 40)
    return h.select(F.lit("t1").alias("column"), "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "count")


@register("ratio_identity", f"""WITH {_cte()}, {TRAIN}
SELECT max(abs(t3 - t2 / greatest(t1, 1e-8))) AS max_abs_diff, CAST(count(*) AS BIGINT) AS n FROM tr""")
def ratio_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max |t3 - t2 / max(t1, 1e-8)| (SI = CC50 / IC50 identity)."""
    r = profile.ratio_identity(_train(spark, sf_dir), "t3", "t2", "t1")
    return r.select("max_abs_diff", F.col("n").cast("bigint").alias("n"))



_EMB_DIMS = 64


def _corr_wide_sql() -> str:
    # the dimensions as rows, joined to themselves on the vector
    return f"""WITH w AS (SELECT vec_id, unnest(range({_EMB_DIMS})) AS d, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS v FROM embeddings)
SELECT 'e' || l.d AS a, 'e' || r.d AS b, {sql_sig('corr(l.v, r.v)', 7)} AS corr
FROM w l JOIN w r ON l.vec_id = r.vec_id AND l.d < r.d GROUP BY l.d, r.d"""


@register("corr_wide", _corr_wide_sql())
def corr_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 on a wide table (64 embedding dimensions, 2,016 pairs) from one Gram pass."""
    w = views.wide(spark, sf_dir, _EMB_DIMS)
    cols = [f"e{i}" for i in range(_EMB_DIMS)]
    return profile.correlations(w, cols).select("a", "b", sig(F.col("corr"), 7).alias("corr"))
