import numpy as np
import pytest

from foldwise.operators import decompose


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    n = 600
    s = np.column_stack([rng.uniform(-1, 1, n), rng.laplace(size=n), np.sign(rng.normal(size=n))])
    x = s @ rng.normal(size=(3, 4)) + 1e6  # a large mean must not eat the variance
    x = np.column_stack([x, np.full(n, 3.0)])
    x[5, 0] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], "extra") for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "index long, a double, b double, c double, d double, k double, note string").repartition(4), np.nan_to_num(x), s


COLS = ["a", "b", "c", "d", "k"]


def test_pca_equals_numpy_and_survives_saving(spark, data, tmp_path):
    df, x, _ = data
    model = decompose.fit_pca(df, COLS)
    c = x - x.mean(axis=0)
    std = c.std(axis=0)
    z = c / np.where(std > 0, std, 1)
    lam, vec = np.linalg.eigh(z.T @ z / len(z))
    assert model.eigenvalues == pytest.approx(lam[::-1].tolist(), abs=1e-7) and model.n == len(x)
    model.save(spark, str(tmp_path / "m"))
    again = decompose.PCAModel.load(spark, str(tmp_path / "m"))
    got = again.transform(df, 2).orderBy("index").toPandas()
    want = z @ vec[:, ::-1][:, :2]
    assert list(got.columns) == [*df.columns, "pc1", "pc2"]
    for k in (0, 1):
        assert np.allclose(np.abs(got[f"pc{k + 1}"]), np.abs(want[:, k]), atol=1e-6)
    assert sum(model.explained()) == pytest.approx(1)
    with pytest.raises(ValueError, match="there already"):
        model.transform(df.withColumnRenamed("note", "pc1"), 2)


def test_ica_finds_the_sources(spark, data, tmp_path):
    df, _, sources = data
    good = df.where("index <> 5")
    model = decompose.fit_ica(good, ["a", "b", "c", "d"], 3)
    model.save(spark, str(tmp_path / "m"))
    got = decompose.ICAModel.load(spark, str(tmp_path / "m")).transform(good).orderBy("index").toPandas()
    y = got[["ic1", "ic2", "ic3"]].to_numpy()
    assert np.allclose(np.cov(y.T, ddof=0), np.eye(3), atol=1e-6) and np.allclose(y.mean(axis=0), 0, atol=1e-6)
    corr = np.abs(np.corrcoef(y.T, np.delete(sources, 5, axis=0).T)[:3, 3:])
    assert (corr.max(axis=1) > 0.95).all() and len(set(corr.argmax(axis=1))) == 3


def test_degenerate_tables(spark, data):
    df, _, _ = data
    with pytest.raises(ValueError, match="no rows"):
        decompose.fit_pca(df.where("index < 0"), COLS)
    with pytest.raises(ValueError, match="no column varies"):
        decompose.fit_ica(df, ["k"], 2)
    assert len(decompose.fit_ica(df, ["a", "k"], 3).unmixing) == 1
