"""Fold assignment: every splitter adds an integer ``fold`` column.

Random choices come from ``stable_hash(index, seed)``, never from row order,
so folds do not depend on partitioning.  Group k-fold never loops over groups
on the driver: groups of equal size are interchangeable, so the greedy
"largest group to the lightest fold" is solved per size bucket in closed form
from the (size -> number of groups) histogram, and groups are then mapped to
folds through a small broadcast range table.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.exprs import stable_hash
from foldwise.operators.groups import with_group_key
from foldwise.operators.numbering import rank_within
from foldwise.operators.quantiles import ALL, medians
from foldwise.operators.skew import join_with_hot_split
from foldwise.session import cut_lineage

log = logging.getLogger(__name__)

DEFAULT_FOLDS = 5
DEFAULT_SEED = 42
SAMPLE_BUCKETS = 10000
# ---- fixed values: K-Means settings of the cluster splitter ----
KMEANS_TOL = 1e-4           # relative to the mean feature variance
KMEANS_MAX_ITER = 300
FIT_FRACTION = 0.75
# ----------------------------------------------------------------


def hash_kfold(df: DataFrame, k: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED, id_col: str = "index") -> DataFrame:
    """fold = stable_hash(id, seed) mod k (balanced in expectation)."""
    return df.withColumn("fold", (stable_hash(id_col, seed) % k).cast("int"))


def stratified_kfold(df: DataFrame, label: str, k: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED,
                     id_col: str = "index") -> DataFrame:
    """Within each class, rows ordered by (hash, id) are dealt to folds
    round-robin, so every fold holds floor or ceil of n_class / k rows."""
    h = df.withColumn("__h", stable_hash(id_col, seed))
    ranked = rank_within(h, ["__h", id_col], [label], out="__r")
    return ranked.withColumn("fold", (F.col("__r") % k).cast("int")).drop("__h", "__r")


def holdout(df: DataFrame, frac: float = 0.1, seed: int = DEFAULT_SEED, id_col: str = "index", name: str = "is_valid") -> DataFrame:
    """max(1, floor(frac * n)) rows, those of smallest hash, get is_valid = true.

    The threshold is found by selection: two histograms of 16 bits of the hash
    (65,536 bins at most, added up before they are shuffled), then the ids among
    the few rows that have the threshold's hash.  Rows do not move.  Rows that
    share an id share a hash and stay together, so repeated ids may add rows."""
    n = df.count()
    if not n:
        return df.withColumn(name, F.lit(True))
    m = max(1, int(frac * n))
    h = stable_hash(id_col, seed)
    hashed = df.select(F.col(id_col).alias("__id"), h.alias("__h"))
    before, prefix = 0, 0
    for shift in (16, 0):
        digit = F.shiftright("__h", shift).bitwiseAND(0xFFFF)
        rows = hashed if shift else hashed.where(F.shiftright("__h", 16) == prefix)
        for r in sorted(rows.groupBy(digit.alias("d")).count().collect()):
            if before + r["count"] >= m:
                prefix = (prefix << 16) | r.d
                break
            before += r["count"]
    last = hashed.where(F.col("__h") == prefix).orderBy("__id").limit(m - before).agg(F.max("__id")).first()[0]
    tied = (h == prefix) & (F.lit(True) if last is None else F.coalesce(F.col(id_col) <= F.lit(last), F.lit(True)))
    return df.withColumn(name, (h < prefix) | tied)


# ---------------------------------------------------------------- group k-fold
def _bucket_counts(loads: list[int], size: int, n_groups: int) -> list[int]:
    """How many of ``n_groups`` groups of ``size`` each fold receives when each
    group goes to the currently lightest fold (lowest index on ties).

    The greedy takes the n_groups smallest pairs (load_f + j * size, f); the
    threshold value V is found by binary search."""
    k = len(loads)

    def count_upto(v: int) -> int:  # pairs with value <= v
        return sum((v - lf) // size + 1 for lf in loads if lf <= v)

    lo, hi = min(loads), min(loads) + n_groups * size
    while lo < hi:
        mid = (lo + hi) // 2
        if count_upto(mid) >= n_groups:
            hi = mid
        else:
            lo = mid + 1
    v = lo
    below = [((v - 1 - lf) // size + 1) if lf <= v - 1 else 0 for lf in loads]
    rest = n_groups - sum(below)
    out = list(below)
    for f in range(k):  # pairs with value exactly v, in fold order
        if rest == 0:
            break
        if loads[f] <= v and (v - loads[f]) % size == 0:
            out[f] += 1
            rest -= 1
    return out


def plan_group_folds(histogram: Sequence[tuple[int, int]], k: int) -> list[tuple[int, int, int, int]]:
    """Range table (size, fold, start, end): groups of ``size`` numbered
    start..end-1 within their bucket go to ``fold``.  Sizes descending."""
    loads = [0] * k
    table = []
    for size, n_groups in sorted(histogram, reverse=True):
        counts = _bucket_counts(loads, size, n_groups)
        start = 0
        for f, c in enumerate(counts):
            if c:
                table.append((size, f, start, start + c))
            start += c
            loads[f] += c * size
    return table


def effective_folds(n_groups: int, k: int) -> int:
    if n_groups < k:
        log.warning("only %d groups for %d folds", n_groups, k)
    return min(k, n_groups)


def group_kfold(df: DataFrame, group_col: str, k: int = DEFAULT_FOLDS) -> DataFrame:
    """Whole groups per fold, fold loads equal to the greedy assignment."""
    spark = df.sparkSession
    # one pass over the rows; histogram, numbering and the hot-key check read the checkpoint
    sizes = cut_lineage(df.groupBy(group_col).agg(F.count(F.lit(1)).alias("__size")))
    hist = [(r["__size"], r["n"]) for r in sizes.groupBy("__size").agg(F.count(F.lit(1)).alias("n")).collect()]
    k_eff = effective_folds(sum(n for _, n in hist), k)
    table = plan_group_folds(hist, k_eff)
    ranges = spark.createDataFrame(table, "__size long, fold int, __start long, __end long")
    numbered = rank_within(sizes.withColumn("__h", F.xxhash64(F.col(group_col).cast("string"))),
                           ["__h", group_col], ["__size"], out="__r")
    # range table is bounded by (#distinct sizes x k) rows: broadcast; equi-join on size
    gfold = (
        numbered.join(F.broadcast(ranges), "__size")
        .filter((F.col("__r") >= F.col("__start")) & (F.col("__r") < F.col("__end")))
        .select(group_col, "fold")
    )
    # a group may hold a third of all rows: hot groups are matched map-side
    return join_with_hot_split(df, gfold, group_col, sizes, "__size")


def duplicate_group_kfold(df: DataFrame, feature_cols: Sequence[str], k: int = DEFAULT_FOLDS,
                          key_col: str | None = None) -> DataFrame:
    """Groups are equal rounded feature vectors (``key_col`` keeps the key)."""
    name = key_col or "__gkey"
    out = group_kfold(with_group_key(df, feature_cols, name), name, k)
    return out if key_col else out.drop(name)


@dataclass
class ClusterFoldResult:
    frame: DataFrame
    features: list[str]
    n_clusters: int


def cluster_features(df: DataFrame, preferred: Sequence[str], numeric: Sequence[str], most: int = 10) -> list[str]:
    """The preferred columns that are there (two or more), else the first ``most`` numeric ones, with a warning that names them."""
    present = [c for c in preferred if c in df.columns]
    if len(present) >= 2:
        return present
    log.warning("clusters are built on %s: fewer than two of %s are there", list(numeric[:most]), list(preferred))
    return list(numeric[:most])


def cluster_kfold(df: DataFrame, features: Sequence[str], k: int = DEFAULT_FOLDS, n_clusters: int = 5,
                  seed: int = DEFAULT_SEED, fit_fraction: float = FIT_FRACTION, id_col: str = "index") -> ClusterFoldResult:
    """K-Means (unscaled, NULL -> median) fitted on a deterministic
    hash sample of the rows, clusters predicted for every row, then group
    k-fold over cluster ids."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    feats = list(features)
    # medians, the sample statistics, K-Means, the cluster sizes and the
    # assignment all read the input: keep it (unless the caller already does)
    # until the fold-tagged table is written
    own = df.storageLevel == StorageLevel.NONE
    if own:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        meds = medians(df, feats)
        filled = df.withColumns({f"__c_{c}": F.coalesce(F.col(c).cast("double"), F.lit(meds.get((c, ALL)) or 0.0)) for c in feats})
        vec = VectorAssembler(inputCols=[f"__c_{c}" for c in feats], outputCol="__cvec").transform(filled)
        sample = vec.filter(stable_hash(id_col, seed) % SAMPLE_BUCKETS < int(fit_fraction * SAMPLE_BUCKETS))
        # the reference's tolerance (1e-4) is relative to the mean feature variance of
        # the fitted rows; MLlib's is an absolute centre shift: translate it
        var = sample.agg(*[F.var_pop(f"__c_{c}").alias(c) for c in feats]).first()
        mean_var = float(np.mean([var[c] or 0.0 for c in feats])) if feats else 0.0
        eps = math.sqrt(KMEANS_TOL * mean_var) if mean_var > 0 else KMEANS_TOL
        km = KMeans(k=n_clusters, seed=seed, maxIter=KMEANS_MAX_ITER, tol=eps, featuresCol="__cvec", predictionCol="__cluster")
        model = km.fit(sample)
        clustered = model.transform(vec).drop("__cvec", *[f"__c_{c}" for c in feats])
        out = cut_lineage(group_kfold(clustered, "__cluster", k), spread=True)
    finally:
        if own:
            df.unpersist()
    return ClusterFoldResult(out, feats, n_clusters)


#: (rows, feature columns, id column) -> the rows with a column ``fold`` 0 .. k-1
Splitter = Callable[[DataFrame, Sequence[str], str], DataFrame]


def make_splitter(strategy: str, k: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED, n_clusters: int = 5,
                  preferred: Sequence[str] = ()) -> Splitter:
    """The splitter of a strategy: 'cluster', 'duplicate_group' or 'hash'."""
    def by_cluster(df: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
        cols = cluster_features(df, preferred, features)
        return cluster_kfold(df, cols, k, n_clusters, seed, id_col=id_col).frame.drop("__cluster")

    found = {
        "cluster": by_cluster,
        "duplicate_group": lambda df, features, id_col: duplicate_group_kfold(df, features, k),
        "hash": lambda df, features, id_col: hash_kfold(df, k, seed, id_col),
    }
    if strategy not in found:
        raise ValueError(f"unknown cv strategy {strategy!r}")
    return found[strategy]
