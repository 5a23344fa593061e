import numpy as np
import pytest

from foldwise.operators import prep


def _frame(spark, n, cols, miss_rows, seed=0):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, len(cols)))
    rows = []
    for i in range(n):
        r = [float(v) for v in data[i]]
        if i in miss_rows:
            r[0] = None
        rows.append((i, *r))
    return spark.createDataFrame(rows, "index long, " + ", ".join(f"{c} double" for c in cols)), data


def test_fit_transform_matches_numpy_and_roundtrip(spark, tmp_path):
    df, data = _frame(spark, 60, ["a", "b"], set(range(6)))
    m = prep.fit(df, exclude=["index"], missing_threshold=0.5)
    assert m.features == ["a", "b"]
    a = data[:, 0].copy()
    a[:6] = np.nan
    med = np.nanmedian(a)
    filled = np.where(np.isnan(a), med, a)
    out = m.transform(df, keep=["index"]).orderBy("index").toPandas()
    assert np.allclose(out["a"], (filled - filled.mean()) / filled.std(), atol=1e-12)
    assert out.shape == (60, 3)
    m.save(spark, str(tmp_path / "prep"))
    again = prep.PrepModel.load(spark, str(tmp_path / "prep"))
    out2 = again.transform(df, keep=["index"]).orderBy("index").toPandas()
    assert np.array_equal(out.to_numpy(), out2.to_numpy())


def test_missing_and_constant_columns_dropped(spark):
    rows = [(i, None if i % 10 < 4 else float(i), 1.0, float(i % 3)) for i in range(50)]
    df = spark.createDataFrame(rows, "index long, sparse double, const double, ok double")
    m = prep.fit(df, exclude=["index"])
    assert m.features == ["ok"] and m.dropped == ["const", "sparse"]


def test_missing_fitted_feature_raises(spark):
    df, _ = _frame(spark, 20, ["a", "b"], set())
    m = prep.fit(df, exclude=["index"])
    with pytest.raises(ValueError):
        m.transform(df.drop("b"))


def test_fold_fit_keeps_full_schema_and_uses_fold_rows(spark):
    df, data = _frame(spark, 80, ["a", "b", "c"], set(range(11)))
    from pyspark.sql import functions as F

    df = df.withColumn("fold", (F.col("index") >= 50).cast("int"))
    full, per = prep.fit_with_folds(df, "fold", [0, 1], exclude=["index", "fold"])
    assert per[0].features == full.features == ["a", "b", "c"]
    a = data[:, 0].copy()
    a[:11] = np.nan
    train_rows = a[50:]                     # fold 0's training rows are the fold-1 rows
    assert per[0].stats["a"].median == pytest.approx(np.nanmedian(train_rows))
    free = prep.fit_folds(df, "fold", [0, 1], exclude=["index", "fold"])
    assert set(free[1].features) <= {"a", "b", "c"}
