import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import folds, groups


def test_duplicate_rows_share_ids_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (2.0, 6.0), (3.0, 7.0), (3.0, 7.0), (4.0, 8.0)], "a double, b double")
    ids = [r.group_id for r in groups.dense_group_ids(df, ["a", "b"]).orderBy("a").collect()]
    assert ids == [0, 0, 1, 2, 2, 3]
    x = spark.createDataFrame([(1.0,), (1.0 + 1e-7,)], "x double")
    assert groups.with_group_key(x, ["x"]).select("gkey").distinct().count() == 1


def test_no_group_on_both_sides(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (2.0, 6.0), (3.0, 7.0), (3.0, 7.0), (4.0, 8.0)], "a double, b double")
    f = folds.duplicate_group_kfold(df, ["a", "b"], 2)
    per_group = groups.with_group_key(f, ["a", "b"]).groupBy("gkey").agg(F.countDistinct("fold").alias("n"))
    assert per_group.filter("n > 1").count() == 0
    assert f.count() == 6 and f.select("fold").distinct().count() == 2


def _greedy(sizes, k):
    loads = [0] * k
    for s in sorted(sizes, reverse=True):
        loads[int(np.argmin(loads))] += s
    return loads


def test_water_filling_equals_greedy():
    random.seed(1)
    for _ in range(2000):
        k = random.randint(2, 7)
        sizes = [random.choice([1, 1, 1, 2, 2, 3, 5, 8, random.randint(1, 50)]) for _ in range(random.randint(1, 200))]
        hist = {}
        for s in sizes:
            hist[s] = hist.get(s, 0) + 1
        loads = [0] * k
        for size, f, a, b in folds.plan_group_folds(list(hist.items()), k):
            loads[f] += size * (b - a)
        assert loads == _greedy(sizes, k)


def test_group_kfold_loads_on_data(spark):
    rng = np.random.default_rng(5)
    g = rng.integers(0, 40, size=500)
    df = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(g)], "index long, g long")
    out = folds.group_kfold(df, "g", 5)
    loads = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert sorted(_greedy(list(np.bincount(g)[np.bincount(g) > 0]), 5)) == loads
    assert out.count() == 500


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_hash_and_stratified_folds_are_partition_invariant(spark, parts):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "index long, label int").repartition(parts)
    h = {r["index"]: r.fold for r in folds.hash_kfold(df, 5, 42).collect()}
    h1 = {r["index"]: r.fold for r in folds.hash_kfold(df.repartition(1), 5, 42).collect()}
    assert h == h1 and len(h) == 300
    s = folds.stratified_kfold(df, "label", 5, 42)
    cnt = {(r.label, r.fold): r["count"] for r in s.groupBy("label", "fold").count().collect()}
    assert all(v == 20 for v in cnt.values()) and len(cnt) == 15


def test_holdout_exact_size(spark):
    df = spark.createDataFrame([(i,) for i in range(123)], "index long")
    h = folds.holdout(df, 0.1, 42)
    assert h.filter("is_valid").count() == 12 and h.count() == 123


def test_fewer_groups_than_folds(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "index long, g long")
    out = folds.group_kfold(df, "g", 5)
    assert out.select("fold").distinct().count() == 2 and out.count() == 10


def test_hot_group_split_keeps_every_row(spark):
    # one vector holds 40 % of the rows
    rows = [(1.0, 1.0)] * 400 + [(float(i % 50), float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double")
    f = folds.duplicate_group_kfold(df, ["a", "b"], 5)
    assert f.count() == 1000
    per_group = groups.with_group_key(f, ["a", "b"]).groupBy("gkey").agg(F.countDistinct("fold").alias("n"))
    assert per_group.filter("n > 1").count() == 0
    ids = groups.dense_group_ids(df, ["a", "b"])
    assert ids.count() == 1000 and ids.filter((F.col("a") == 1.0) & (F.col("b") == 1.0)).select("group_id").distinct().count() == 1
