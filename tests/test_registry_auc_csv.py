import numpy as np
import pytest

from foldwise.operators import diagnose, models
from foldwise.sources import files


def test_registry_names_unique_and_ordered():
    names = models.registry()
    assert names[:9] == ["lgb", "xgb", "ridge", "elastic_net", "hist_gbrt", "random_forest", "extra_trees",
                         "grad_boosting_sklearn", "bayesian_ridge"]
    assert len(set(names)) == len(names)


def test_exact_auc_with_ties_matches_pairs(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, size=300)
    s = np.round(rng.normal(size=300) + y, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double").repartition(5)
    got = diagnose.exact_auc(df, "label", "score").first().auc
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(brute, abs=1e-12)


def test_csv_edge_cells(spark, tmp_path):
    p = tmp_path / "edge.csv"
    p.write_text("v\n\"\"\nnan\nNaN\ninf\n-inf\nInf\n1e5\n-0.0\n")
    vals = [r.v for r in files.read_csv(spark, str(p)).collect()]
    assert vals[:6] == [None] * 6
    assert vals[6] == 100000.0 and vals[7] == 0.0 and str(vals[7]) == "0.0"


def test_csv_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "nope.csv"))


def test_gram_correlation_equals_pairwise(spark):
    from foldwise.operators import profile

    rng = np.random.default_rng(4)
    n, p = 400, 5
    x = rng.normal(size=(n, p)) * [1, 10, 100, 0.1, 3] + [0, 5, -50, 1, 2]
    x[:, 1] += x[:, 0] * 3
    x[rng.random((n, p)) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x],
                               ", ".join(f"c{j} double" for j in range(p)))
    cols = [f"c{j}" for j in range(p)]
    a = {(r.a, r.b): r.corr for r in profile.correlation_pairs(df, cols).collect()}
    b = {(r.a, r.b): r.corr for r in profile.correlations(df, cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == pytest.approx(a[k], abs=1e-10)


def test_constant_columns_have_no_correlation_and_no_shift(spark):
    from foldwise.operators import profile

    df = spark.createDataFrame([(float(i), 0.1, None if i % 3 else 0.1) for i in range(50)], "x double, c double, s double")
    for got in (profile.correlation_pairs(df, ["x", "c", "s"]), profile.correlations(df, ["x", "c", "s"])):
        assert [r.corr for r in got.collect()] == [None] * 3
    shift = {r.feature: r["shift"] for r in profile.mean_shift(df, df.withColumn("x", df.x + 1), ["x", "c"]).collect()}
    assert shift["c"] is None and shift["x"] == pytest.approx(1 / np.std(np.arange(50), ddof=1))
