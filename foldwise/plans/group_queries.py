"""Duplicate-group and fold queries (steps 3-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.exprs import grouping_value
from foldwise.operators import folds, groups, profile
from foldwise.plans.core_queries import _cte
from foldwise.plans.registry import register
from foldwise.plans.rounding import sig, sql_sig
from foldwise.sources import views
from foldwise.sources.views import BINARY_SQL, DUPES_FEATURES, DUPES_SQL, ID

K = 5
SEED = 42
_R = ", ".join(f"round_even(coalesce({c}, 0.0), 6) + 0.0 AS r{i}" for i, c in enumerate(DUPES_FEATURES))
_RG = ", ".join(f"r{i}" for i in range(len(DUPES_FEATURES)))
DUP_CTE = f"d AS ({DUPES_SQL}), dr AS (SELECT {_R}, y FROM d), g AS (SELECT {_RG}, count(*) AS size, max(y) - min(y) AS spread, avg(abs(y)) AS meanabs FROM dr GROUP BY {_RG})"


def _dupe_groups(spark, sf_dir, targets=("y",)):
    return groups.group_table(views.dupes(spark, sf_dir), DUPES_FEATURES, targets)


@register("row_groups", f"""WITH {DUP_CTE}
SELECT CAST(size AS BIGINT) AS size, CAST(count(*) AS BIGINT) AS n_groups FROM g GROUP BY size""")
def row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P17 + P18: rows keyed by their rounded vector; the group-size histogram."""
    return groups.size_histogram(_dupe_groups(spark, sf_dir)).select(
        F.col("size").cast("bigint").alias("size"), F.col("n_groups").cast("bigint").alias("n_groups"))


@register("dense_group_ids", f"""WITH {DUP_CTE}
SELECT CAST(dense_rank() OVER (ORDER BY {_RG}) - 1 AS BIGINT) AS group_id, {_RG}, CAST(size AS BIGINT) AS size FROM g""")
def dense_group_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: dense ids in lexicographic order of the rounded vectors (offset numbering)."""
    d = views.dupes(spark, sf_dir)
    ided = groups.dense_group_ids(d, DUPES_FEATURES)
    rounded = [grouping_value(c).alias(f"r{i}") for i, c in enumerate(DUPES_FEATURES)]
    return ided.groupBy("group_id", *rounded).agg(F.count(F.lit(1)).alias("size")).select(
        F.col("group_id").cast("bigint").alias("group_id"), *[f"r{i}" for i in range(len(DUPES_FEATURES))],
        F.col("size").cast("bigint").alias("size"))


@register("dup_summary", f"""WITH {DUP_CTE}
SELECT CAST(sum(size) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_unique_groups,
       CAST(sum(CASE WHEN size > 1 THEN size ELSE 0 END) AS BIGINT) AS n_rows_in_multi_groups,
       round(100.0 * sum(CASE WHEN size > 1 THEN size ELSE 0 END) / sum(size), 2) AS pct_rows_in_multi_groups,
       CAST(count(*) FILTER (WHERE size > 1) AS BIGINT) AS n_multi_groups,
       CAST(sum(size) - count(*) AS BIGINT) AS rows_beyond_first
FROM g""")
def dup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate counts under both definitions."""
    return groups.duplicate_summary(_dupe_groups(spark, sf_dir))


@register("dup_target_spread", f"""WITH {DUP_CTE}, m AS (SELECT spread, spread / (meanabs + 1e-9) AS rel FROM g WHERE size > 1)
SELECT 'y' AS target, CAST(count(*) FILTER (WHERE spread > 1e-6) AS BIGINT) AS groups_with_spread,
       {sql_sig('coalesce(median(rel), 0.0)', 9)} AS median_relative_spread,
       {sql_sig('coalesce(max(rel), 0.0)', 9)} AS max_relative_spread FROM m""")
def dup_target_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target disagreement inside duplicate groups (exact median of relative spread)."""
    rows = groups.target_spread(_dupe_groups(spark, sf_dir), ["y"])
    df = spark.createDataFrame(
        [(r["target"], r["groups_with_spread_gt_1e-6"], r["median_relative_spread"], r["max_relative_spread"]) for r in rows],
        "target string, groups_with_spread bigint, median_relative_spread double, max_relative_spread double")
    return df.select("target", "groups_with_spread", sig(F.col("median_relative_spread"), 9).alias("median_relative_spread"),
                     sig(F.col("max_relative_spread"), 9).alias("max_relative_spread"))


def _hist_sql(src: str, col: str, kind: str, bins: int = 30) -> str:
    return f"""SELECT '{kind}' AS kind, CAST(gb.bin AS INTEGER) AS bin, round(w.lo + gb.bin * w.width, 6) AS lo,
       round(w.lo + (gb.bin + 1) * w.width, 6) AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range({bins}) gb(bin)
CROSS JOIN (SELECT min({col}) AS lo, CASE WHEN max({col}) > min({col}) THEN (max({col}) - min({col})) / {bins} ELSE 1.0 END AS width FROM {src}) w
LEFT JOIN (SELECT least(CAST(floor(({col} - w2.lo) / w2.width) AS INTEGER), {bins} - 1) AS bin, count(*) AS n
           FROM {src}, (SELECT min({col}) AS lo, CASE WHEN max({col}) > min({col}) THEN (max({col}) - min({col})) / {bins} ELSE 1.0 END AS width FROM {src}) w2
           WHERE {col} IS NOT NULL GROUP BY 1) c ON c.bin = gb.bin"""


@register("dup_histogram", f"""WITH {DUP_CTE}, mg AS (SELECT CAST(size AS DOUBLE) AS size, spread FROM g WHERE size > 1)
{_hist_sql('mg', 'size', 'group_size')}
UNION ALL
{_hist_sql('mg', 'spread', 'y_spread')}""")
def dup_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-bin histograms of multi-group sizes and of the in-group target range."""
    mg = _dupe_groups(spark, sf_dir).filter(F.col("size") > 1).select(
        F.col("size").cast("double").alias("size"), F.col("y__spread").alias("spread"))
    out = None
    for col, kind in (("size", "group_size"), ("spread", "y_spread")):
        h = profile.histogram(mg, col, 30).select(F.lit(kind).alias("kind"), "bin", F.round("lo", 6).alias("lo"),
                                                   F.round("hi", 6).alias("hi"), "count")
        out = h if out is None else out.unionByName(h)
    return out


def _greedy_sql(k: int = K) -> str:
    ls = [f"l{f}" for f in range(k)]
    least = f"least({', '.join('w.' + c for c in ls)})"
    picks = []
    for f in range(k):
        cond = [f"w.l{f} = {least}"] + [f"w.l{j} > {least}" for j in range(f)]
        picks.append(" AND ".join(cond))
    upd = ", ".join(f"w.l{f} + CASE WHEN {picks[f]} THEN o.size ELSE 0 END" for f in range(k))
    cnt = ", ".join(f"w.c{f} + CASE WHEN {picks[f]} THEN 1 ELSE 0 END" for f in range(k))
    init = ", ".join(["0"] * (2 * k))
    cols = ", ".join(ls + [f"c{f}" for f in range(k)])
    final = "\nUNION ALL ".join(f"SELECT {f} AS fold, CAST(l{f} AS BIGINT) AS n_rows, CAST(c{f} AS BIGINT) AS n_groups FROM fin" for f in range(k))
    return f"""WITH RECURSIVE {DUP_CTE},
o AS (SELECT size, row_number() OVER (ORDER BY size DESC) AS i FROM g),
walk(i, {cols}) AS (SELECT 0, {init} UNION ALL
  SELECT o.i, {upd}, {cnt} FROM walk w JOIN o ON o.i = w.i + 1),
fin AS (SELECT * FROM walk WHERE i = (SELECT max(i) FROM o))
{final}"""


@register("group_kfold_loads", _greedy_sql())
def group_kfold_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C3: duplicate-group k-fold; rows and groups per fold equal the greedy's."""
    keyed = folds.duplicate_group_kfold(views.dupes(spark, sf_dir), DUPES_FEATURES, K, key_col="gkey")
    return keyed.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("gkey").alias("n_groups")).select(
        F.col("fold").cast("int").alias("fold"), F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("n_groups").cast("bigint").alias("n_groups"))


@register("fold_coverage", f"""WITH {DUP_CTE}
SELECT CAST(sum(size) AS BIGINT) AS n_rows, CAST(sum(size) AS BIGINT) AS n_assigned,
       CAST(0 AS BIGINT) AS groups_split, CAST({K} AS BIGINT) AS n_folds FROM g""")
def fold_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariants: every row validated exactly once, no group on both sides of a split."""
    keyed = folds.duplicate_group_kfold(views.dupes(spark, sf_dir), DUPES_FEATURES, K, key_col="gkey")
    per_group = keyed.groupBy("gkey").agg(F.countDistinct("fold").alias("nf"), F.count(F.lit(1)).alias("n"))
    return per_group.agg(
        F.sum("n").cast("bigint").alias("n_rows"), F.sum("n").cast("bigint").alias("n_assigned"),
        F.count(F.when(F.col("nf") > 1, 1)).cast("bigint").alias("groups_split"),
    ).crossJoin(keyed.agg(F.countDistinct("fold").cast("bigint").alias("n_folds")))


_H = "('0x' || substr(md5(CAST({c} AS VARCHAR) || ':{s}'), 1, 8))::BIGINT"


@register("hash_kfold", f"""WITH {_cte()}
SELECT CAST({_H.format(c='"index"', s=SEED)} % {K} AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n,
       CAST(sum("index") AS VARCHAR) AS id_sum FROM a WHERE NOT is_test GROUP BY 1""")
def hash_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded, order-free k-fold."""
    tr = folds.hash_kfold(views.train_part(views.assay(spark, sf_dir)), K, SEED)
    return tr.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(ID).cast("decimal(20,0)")).cast("string").alias("id_sum"))


@register("stratified_kfold", f"""WITH b AS ({BINARY_SQL}),
r AS (SELECT quality, doc_id, row_number() OVER (PARTITION BY quality ORDER BY {_H.format(c='doc_id', s=SEED)}, doc_id) - 1 AS rk FROM b)
SELECT quality, CAST(rk % {K} AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n, CAST(sum(doc_id) AS VARCHAR) AS id_sum
FROM r GROUP BY 1, 2""")
def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class proportions kept in every fold."""
    b = folds.stratified_kfold(views.binary(spark, sf_dir), "quality", K, SEED, id_col="doc_id")
    return b.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("doc_id").cast("decimal(20,0)")).cast("string").alias("id_sum"))


@register("holdout", f"""WITH {_cte()}, tr AS (SELECT "index" FROM a WHERE NOT is_test),
r AS (SELECT "index", row_number() OVER (ORDER BY {_H.format(c='"index"', s=SEED)}, "index") - 1 AS rk FROM tr)
SELECT rk < greatest(1, CAST(floor(0.1 * (SELECT count(*) FROM tr)) AS BIGINT)) AS is_valid,
       CAST(count(*) AS BIGINT) AS n, CAST(sum("index") AS VARCHAR) AS id_sum FROM r GROUP BY 1""")
def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly max(1, floor(0.1 n)) validation rows chosen by hash."""
    h = folds.holdout(views.train_part(views.assay(spark, sf_dir)).select(ID), 0.1, SEED)
    return h.groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(ID).cast("decimal(20,0)")).cast("string").alias("id_sum"))


@register("cluster_kfold")
def cluster_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-Means on a 75 % hash sample, group k-fold over clusters (no SQL twin)."""
    tr = views.train_part(views.assay(spark, sf_dir))
    res = folds.cluster_kfold(tr, views.CLUSTER_FEATURES, K, 5, SEED)
    return res.frame.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("__cluster").alias("n_clusters"))
