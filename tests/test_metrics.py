import numpy as np
import pytest

from foldwise.operators import blend, metrics


def _oof(spark, rows):
    return spark.createDataFrame(rows, "index long, target string, model string, fold int, y double, pred double")


def test_rmse_zero_and_score_is_mean(spark):
    rows = [(i, t, "m", 0, float(i), float(i) + (d if t == "b" else 0)) for i in range(10) for t, d in (("a", 0.0), ("b", 3.0))]
    r = {x.target: x.rmse for x in metrics.rmse_by(_oof(spark, rows), ["target"]).collect()}
    assert r["a"] == 0.0 and r["b"] == pytest.approx(3.0)
    s = metrics.competition_score(metrics.rmse_by(_oof(spark, rows), ["target"])).first()
    assert s.score == pytest.approx(1.5)


def test_inverse_weights_sum_to_one(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "t", m, 0, float(y), float(y + rng.normal() * s)) for i, y in enumerate(rng.normal(size=50))
            for m, s in (("m1", 1.0), ("m2", 2.0), ("m3", 5.0))]
    w = {r.model: r.weight for r in metrics.inverse_rmse_weights(_oof(spark, rows)).collect()}
    assert sum(w.values()) == pytest.approx(1.0)
    assert w["m1"] > w["m2"] > w["m3"]


def test_weighted_ensemble_defaults(spark):
    preds = spark.createDataFrame(
        [(0, "IC50", "a", 2.0), (0, "IC50", "b", 4.0), (0, "CC50", "a", 10.0), (0, "SI", "a", 1.0), (0, "SI", "b", 3.0)],
        "index long, target string, model string, pred double")
    w = spark.createDataFrame([("IC50", "a", 1.0), ("IC50", "b", 3.0)], "target string, model string, weight double")
    got = {r.target: r.pred for r in metrics.weighted_ensemble(preds, w).collect()}
    assert got == {"IC50": 3.5, "CC50": 10.0, "SI": 2.0}


def test_blend_search_never_worse_than_inverse(spark):
    rng = np.random.default_rng(1)
    n = 80
    rows = []
    for t, sd in (("IC50", 20), ("CC50", 20), ("SI", 5)):
        y = rng.normal(size=n) * 100
        for m in range(4):
            p = y + rng.normal(size=n) * sd * (m + 1)
            rows += [(i, t, f"m{m}", 0, float(y[i]), float(p[i])) for i in range(n)]
    oof = _oof(spark, rows)
    names = [f"m{m}" for m in range(4)]
    moms = blend.error_moments(oof, ["IC50", "CC50", "SI"], names)
    w, best, parts = blend.blend_search(moms, ["IC50", "CC50", "SI"], 100, 42)
    inv = {t: blend.inverse_rmse_from_moments(*moms[t]) for t in moms}
    inv_score = np.mean([np.sqrt(inv[t] @ moms[t][0] @ inv[t] / moms[t][1]) for t in moms])
    assert best <= inv_score + 1e-12
    for t in w:
        assert w[t].sum() == pytest.approx(1.0)
    # the error-Gram score equals the RMSE of the blended predictions
    t = "SI"
    pdf = oof.filter(oof.target == t).toPandas().pivot(index="index", columns="model", values="pred")
    y = oof.filter((oof.target == t) & (oof.model == "m0")).toPandas().set_index("index")["y"]
    direct = np.sqrt(np.mean((pdf[names].to_numpy() @ w[t] - y.loc[pdf.index].to_numpy()) ** 2))
    assert direct == pytest.approx(parts[t], rel=1e-9)
