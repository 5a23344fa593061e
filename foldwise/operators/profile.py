"""Column profiling: missing ratios, describe, skew, correlation, distinct counts,
mean shift, prefix means and histograms.

Wide tables are handled in long form (one row per (feature, value)) built by a
narrow explode, so the number of aggregate expressions stays constant in p and
distinct counts shuffle distinct pairs only (partially de-duplicated map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.quantiles import ALL, long_form, quantiles
from foldwise.session import cut_lineage


def missing_top(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """A2 + T1: missing ratio per column, only > 0, the k largest (ties by name)."""
    agg = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = agg.unpivot([], list(cols), "column", "missing_ratio")
    return long.filter(F.col("missing_ratio") > 0).orderBy(F.desc("missing_ratio"), "column").limit(k)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (ddof 1), min, exact quartiles (linear), max per column."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)   # moments, counts and quantiles read it
    try:
        return cut_lineage(_describe(df, cols))       # materialised before the input is released
    finally:
        df.unpersist()


def _describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = long_form(df, cols)
    moments = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    q = quantiles(df, cols, (0.25, 0.5, 0.75))
    spark = df.sparkSession
    qt = spark.createDataFrame(
        [(c, q[(c, ALL, 0.25)], q[(c, ALL, 0.5)], q[(c, ALL, 0.75)]) for c in cols],
        "feature string, q25 double, q50 double, q75 double",
    )
    return moments.join(F.broadcast(qt), "feature", "right").select(
        "feature", F.coalesce(F.col("count"), F.lit(0)).alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-adjusted sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    long = long_form(df, cols)
    g = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.skewness("value").alias("g1"))
    n = F.col("n").cast("double")
    return g.select("feature", "n", F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"))


def correlation_pairs(df: DataFrame, cols: Sequence[str], others: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation with pairwise-complete rows, for every pair a < b
    of ``cols`` (or every (col, other) pair).  One aggregate pass; a column
    that is constant over a pair's rows has a NULL correlation."""
    def both(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    if others is None:
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    else:
        pairs = [(a, b) for a in cols for b in others if a != b]
    agg = df.agg(*[both(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    long = agg.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)
    ])).alias("p"))
    return long.select("p.a", "p.b", "p.corr")


def top_k_per(df: DataFrame, part: str, score: Column | str, k: int, tie: str) -> DataFrame:
    """K best rows per ``part`` by ``score`` descending, ties broken by ``tie``.
    The input is a small per-feature table (one row per feature x part)."""
    w = Window.partitionBy(part).orderBy(F.desc(score) if isinstance(score, str) else score.desc(), tie)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: exact number of distinct non-NULL values per column (long form:
    distinct (feature, value) pairs, then a count per feature)."""
    long = long_form(df, cols).withColumn("value", F.col("value") + F.lit(0.0))
    return long.select("feature", "value").distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("nunique"))


def mean_shift(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """|mean_test - mean_train| / std_train (ddof 1) per column from a tagged union
    (NULL for a column that is constant in train)."""
    both = long_form(train, cols).withColumn("is_test", F.lit(False)).unionByName(
        long_form(test, cols).withColumn("is_test", F.lit(True))
    )
    g = both.groupBy("feature").agg(
        F.avg(F.when(~F.col("is_test"), F.col("value"))).alias("mean_train"),
        F.avg(F.when(F.col("is_test"), F.col("value"))).alias("mean_test"),
        F.stddev_samp(F.when(~F.col("is_test"), F.col("value"))).alias("std_train"),
    )
    return g.withColumn("shift", F.try_divide(F.abs(F.col("mean_test") - F.col("mean_train")), F.col("std_train")))


def prefix_means(df: DataFrame, prefix: str) -> DataFrame:
    """Mean of every column whose name starts with ``prefix``."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, mean double")
    return long_form(df, cols).groupBy("feature").agg(F.avg("value").alias("mean"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept."""
    spark = df.sparkSession
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = mm.lo, mm.hi
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def ratio_identity(df: DataFrame, ratio: str, num: str, den: str, eps: float = 1e-8) -> DataFrame:
    """Max |ratio - num / max(den, eps)|."""
    d = F.abs(F.col(ratio) - F.col(num) / F.greatest(F.col(den), F.lit(eps)))
    return df.agg(F.max(d).alias("max_abs_diff"), F.count(F.lit(1)).alias("n"))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A14 for any width: pairwise-complete Pearson correlations of every pair
    from ONE scan, NULL where a column is constant over the pair's rows.  The moment matrix of [x0 | x0^2 | NULL flags | 1] (x0 = x - c,
    0 where NULL) contains, for each pair, the count, sums, sums of squares and
    cross products over the rows where both are present."""
    import numpy as np

    from foldwise.operators import gram

    p = len(cols)
    # any constant centre works; the column means keep the sums well conditioned
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = [float(means[f"m{i}"] or 0.0) for i in range(p)]
    sq = [F.pow(F.col(c).cast("double") - F.lit(centre[i]), 2).alias(f"__sq{i}") for i, c in enumerate(cols)]
    # x0^2 enters as extra "features" centred at 0, so the pass yields their cross moments too
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols], *sq)
    mom = gram.moments(wide, [*cols, *[f"__sq{i}" for i in range(p)]], [], None, [*centre, *([0.0] * p)]).total()
    q = 2 * p                     # layout: x0 (p) | x0^2 (p) | flags (2p) | 1
    one = 2 * q
    x0 = lambda i: i              # noqa: E731
    x2 = lambda i: p + i          # noqa: E731
    z = lambda i: q + i           # noqa: E731  NULL flag of column i
    rows = []
    for i in range(p):
        for j in range(i + 1, p):
            n = mom[one, one] - mom[one, z(i)] - mom[one, z(j)] + mom[z(i), z(j)]
            si = mom[one, x0(i)] - mom[z(j), x0(i)]
            sj = mom[one, x0(j)] - mom[z(i), x0(j)]
            sii = mom[one, x2(i)] - mom[z(j), x2(i)]
            sjj = mom[one, x2(j)] - mom[z(i), x2(j)]
            sij = mom[x0(i), x0(j)]
            cov = sij - si * sj / n if n > 0 else np.nan
            vi, vj = sii - si * si / n if n > 0 else np.nan, sjj - sj * sj / n if n > 0 else np.nan
            # a spread below the rounding of the centred values is a constant column
            varies = n > 1 and vi > n * (1e-14 * centre[i]) ** 2 and vj > n * (1e-14 * centre[j]) ** 2
            r = cov / np.sqrt(vi * vj) if varies else None
            rows.append((cols[i], cols[j], None if r is None else float(r)))
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")
