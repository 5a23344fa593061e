"""Closed-form checks of the Gram-based linear family against numpy on the raw rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import blend, gram, models, oof, prep


def _frame(spark, n=240, p=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * rng.uniform(0.1, 50, size=p) + rng.uniform(-100, 100, size=p)
    x[:, 4] = x[:, 3] * 0.5 + rng.normal(size=n) * 0.01          # near-collinear pair
    beta = rng.normal(size=p)
    y = x @ beta + rng.normal(size=n) * 3 + 10
    miss = rng.random((n, p)) < 0.05
    rows = []
    for i in range(n):
        rows.append((i, i % 4, *[None if miss[i, j] else float(x[i, j]) for j in range(p)], float(y[i])))
    cols = [f"x{j}" for j in range(p)]
    df = spark.createDataFrame(rows, "index long, fold int, " + ", ".join(f"{c} double" for c in cols) + ", y double")
    xm = np.where(miss, np.nan, x)
    return df, cols, xm, y


def _design_np(m: prep.PrepModel, cols, xm):
    out = []
    for j, c in enumerate(cols):
        s = m.stats[c]
        out.append((np.where(np.isnan(xm[:, j]), s.median, xm[:, j]) - s.mean) / s.scale)
    return np.column_stack(out)


@pytest.fixture(scope="module")
def fitted(spark):
    df, cols, xm, y = _frame(spark)
    full, per = prep.fit_with_folds(df, "fold", [0, 1, 2, 3], features=cols)
    cfg = oof.OOFConfig(k=4, seed=42, candidates=models.LINEAR, inverse="plain")
    fits, centre = oof.fit_linear(df, cols, [("y", False)], full, per, cfg)
    o = oof.apply_linear(df, [f for f in fits if f.scope != -1], cols, centre, [("y", False)], "plain", "fold").toPandas()
    return dict(df=df, cols=cols, xm=xm, y=y, full=full, per=per, fits=fits, oof=o, fold=np.arange(len(y)) % 4)


def test_ridge_loo_matches_brute_force(fitted):
    for f in range(4):
        tr = fitted["fold"] != f
        xs = _design_np(fitted["per"][f], fitted["cols"], fitted["xm"][tr])
        y = fitted["y"][tr]
        xc, yc = xs - xs.mean(0), y - y.mean()
        best = None
        for a in gram.RIDGE_ALPHAS:
            inv = np.linalg.inv(xc.T @ xc + a * np.eye(xc.shape[1]))
            h = np.einsum("ij,jk,ik->i", xc, inv, xc) + 1.0 / len(y)
            w = inv @ xc.T @ yc
            e = np.sum(((yc - xc @ w) / (1 - h)) ** 2)
            if best is None or e < best[0]:
                best = (e, a, w)
        fit = [x for x in fitted["fits"] if x.scope == f and x.model == "ridge"][0]
        assert fit.info["alpha"] == best[1]
        xv = _design_np(fitted["per"][f], fitted["cols"], fitted["xm"][~tr])
        pred = y.mean() + (xv - xs.mean(0)) @ best[2]
        got = fitted["oof"].query("model == 'ridge' and fold == @f").sort_values("index")["pred"].to_numpy()
        assert np.allclose(got, pred, rtol=1e-9, atol=1e-9)


def _bayes_np(x, y, max_iter=500, tol=1e-3, e=1e-6):
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    n = len(y)
    _, s, vh = np.linalg.svd(xc, full_matrices=False)
    eig = s ** 2
    alpha, lam = 1.0 / (np.var(yc) + np.finfo(float).eps), 1.0
    xty = xc.T @ yc
    old = None
    for _ in range(max_iter):
        coef = vh.T @ ((vh @ xty) / (eig + lam / alpha))
        rmse = np.sum((yc - xc @ coef) ** 2)
        gamma = np.sum(alpha * eig / (lam + alpha * eig))
        lam = (gamma + 2 * e) / (np.sum(coef ** 2) + 2 * e)
        alpha = (n - gamma + 2 * e) / (rmse + 2 * e)
        if old is not None and np.sum(np.abs(old - coef)) < tol:
            break
        old = coef
    coef = vh.T @ ((vh @ xty) / (eig + lam / alpha))
    return coef, ym - xm @ coef


def test_bayesian_ridge_matches_svd_reference(fitted):
    for f in range(4):
        tr = fitted["fold"] != f
        xs = _design_np(fitted["per"][f], fitted["cols"], fitted["xm"][tr])
        coef, b0 = _bayes_np(xs, fitted["y"][tr])
        xv = _design_np(fitted["per"][f], fitted["cols"], fitted["xm"][~tr])
        got = fitted["oof"].query("model == 'bayesian_ridge' and fold == @f").sort_values("index")["pred"].to_numpy()
        assert np.allclose(got, b0 + xv @ coef, rtol=1e-7, atol=1e-7)


def test_elastic_net_path_is_optimal():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 6))
    x[:, 5] = x[:, 4] * 0.999 + 0.001 * x[:, 5]
    y = x @ np.array([1, 0, 0, 2, 0.5, 0.5]) + rng.normal(size=150)
    x, y = x - x.mean(0), y - y.mean()
    g, b = x.T @ x, x.T @ y
    for r in (0.1, 0.5, 0.99):
        al = gram.enet_alphas(b, 150, r)
        w = gram.enet_path(g, b, 150, al, r, y @ y)
        for k in (0, 30, 99):
            ref = gram._enet_cd(g, b, 150 * al[k] * r, 150 * al[k] * (1 - r), np.zeros(6), y @ y, 200000, 1e-15)
            assert np.allclose(w[:, k], ref, atol=1e-7)
        assert np.all(w[:, 0] == 0)        # alpha_max: everything is zero


def test_meta_oof_complete_and_not_in_sample(spark, fitted):
    o = spark.createDataFrame(fitted["oof"])
    meta = blend.meta_oof_ridge(o, "y", list(models.LINEAR), 5, 42)
    nested = meta.oof_meta.toPandas()
    assert len(nested) == len(fitted["y"]) and nested["pred"].notna().all()
    ins = blend.meta_in_sample(o, meta, list(models.LINEAR)).toPandas().set_index("index").sort_index()
    assert not np.allclose(nested.set_index("index").sort_index()["pred"], ins["pred"])


def test_moments_match_numpy(spark, fitted):
    df, cols = fitted["df"], fitted["cols"]
    centre = [1.0, -2.0, 0.5, 3.0, 0.0]
    mom = gram.moments(df, cols, ["y"], "fold", centre)
    a = np.column_stack([np.nan_to_num(fitted["xm"] - np.array(centre), nan=0.0), np.isnan(fitted["xm"]).astype(float),
                         np.ones(len(fitted["y"])), fitted["y"]])
    for f in range(4):
        sub = a[fitted["fold"] == f]
        assert np.allclose(mom.cells[f], sub.T @ sub, rtol=1e-12)
    _ = F


def test_stacked_predict_matches_hand_computation(spark):
    names = ["m1", "m2"]
    metas = {
        "a": blend.MetaResult("a", None, oof.LinearFit(-1, "meta", "ridge", [0.5, 2.0, 3.0, -1.0, 10.0]), [], [1.0, 2.0]),
        "b": blend.MetaResult("b", None, oof.LinearFit(-1, "meta", "ridge", [1.5, -0.5, 0.0, 0.0, 1.0]), [], [0.0, 4.0]),
    }
    rows = [(1, "a", "m1", 3.0), (1, "a", "m2", 5.0), (1, "b", "m1", 2.0), (1, "b", "m2", 8.0),
            (2, "a", "m1", None), (2, "a", "m2", 1.0),            # a NULL model input; target b missing
            (3, "b", "m1", 1.0), (3, "b", "m2", 4.0)]             # target a missing
    base = spark.createDataFrame(rows, "index long, target string, model string, pred double")
    got = {r["index"]: (r["a"], r["b"]) for r in blend.stacked_predict(base, metas, names).collect()}

    def hand(meta, xs):
        beta, c = meta.final.beta, meta.centre
        a = [0.0 if x is None else x - ci for x, ci in zip(xs, c)] + [1.0 if x is None else 0.0 for x in xs] + [1.0]
        return float(np.dot(a, beta))

    assert got[1] == pytest.approx((hand(metas["a"], [3.0, 5.0]), hand(metas["b"], [2.0, 8.0])))
    assert got[2][0] == pytest.approx(hand(metas["a"], [None, 1.0])) and got[2][1] is None
    assert got[3][0] is None and got[3][1] == pytest.approx(hand(metas["b"], [1.0, 4.0]))
