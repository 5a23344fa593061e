"""Per-fold preprocessing statistics (step 5): k fold fits from one set of passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import folds, prep
from foldwise.plans.core_queries import FEATURES, _cte, assay_features
from foldwise.plans.registry import register
from foldwise.plans.rounding import sig, sql_sig
from foldwise.sources import views

K = 5
SEED = 42
_H = "('0x' || substr(md5(CAST(\"index\" AS VARCHAR) || ':42'), 1, 8))::BIGINT"


def _fold_sql() -> str:
    parts = []
    for c in FEATURES:
        parts.append(f"""SELECT fl.fold, '{c}' AS feature,
  avg(CASE WHEN tr.{c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_ratio, any_value(fm.m) AS median,
  avg(coalesce(tr.{c}, fm.m)) AS mean, stddev_pop(coalesce(tr.{c}, fm.m)) AS std, var_samp(coalesce(tr.{c}, fm.m)) AS var_samp
FROM fl JOIN (SELECT fl.fold, median(tr.{c}) AS m FROM fl JOIN tr ON tr.fold <> fl.fold GROUP BY fl.fold) fm ON fm.fold = fl.fold
JOIN tr ON tr.fold <> fl.fold GROUP BY fl.fold""")
    body = "\nUNION ALL\n".join(parts)
    full = """(SELECT feature FROM (VALUES ('n_lines'), ('sum_qty'), ('avg_price'), ('avg_disc'), ('max_tax'), ('f_mod7'),
       ('acctbal'), ('LogP_TPSA'), ('Charge_sum'), ('fr_imide_flag'), ('Ring_LogP'), ('FractionCSP3_LogP')) v(feature))"""
    return f"""WITH {_cte()}, tr AS (SELECT *, CAST({_H} % {K} AS INTEGER) AS fold FROM af WHERE NOT is_test),
fl AS (SELECT DISTINCT fold FROM tr),
s AS ({body})
SELECT CAST(fold AS INTEGER) AS fold, feature, round(missing_ratio, 9) AS missing_ratio, {sql_sig('median', 9)} AS median,
       {sql_sig('mean', 8)} AS mean, {sql_sig('std', 7)} AS std,
       feature IN {full} AS kept_frozen,
       NOT (missing_ratio > 0.3 OR var_samp <= 1e-12) AS kept_free
FROM s"""


@register("prep_stats_by_fold", _fold_sql())
def prep_stats_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M6: medians / scaler per fold from the other folds' rows; the frozen
    schema copies the full fit's columns, the free one screens per fold."""
    tr = folds.hash_kfold(views.train_part(assay_features(spark, sf_dir)), K, SEED)
    # the full fit is the ALL scope of the same passes that fit every fold
    full, free = prep.fit_with_folds(tr, "fold", list(range(K)), features=FEATURES, frozen=False)
    frozen = set(full.features)
    rows = []
    for f, m in free.items():
        for c in FEATURES:
            s = m.stats.get(c) or m.screened[c]
            rows.append((f, c, s.missing_ratio, s.median, s.mean, s.std, c in frozen, c in m.features))
    df = spark.createDataFrame(rows, "fold int, feature string, missing_ratio double, median double, mean double, std double, kept_frozen boolean, kept_free boolean")
    return df.select("fold", "feature", F.round("missing_ratio", 9).alias("missing_ratio"), sig(F.col("median"), 9).alias("median"),
                     sig(F.col("mean"), 8).alias("mean"), sig(F.col("std"), 7).alias("std"), "kept_frozen", "kept_free")
