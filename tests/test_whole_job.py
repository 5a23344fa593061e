"""The registered queries run the whole job: every candidate, round and trial."""

from types import SimpleNamespace

import numpy as np
import pytest

from foldwise.operators import diagnose, models, oof, search
from foldwise.plans import program_queries as Q
from foldwise.plans import registry
from foldwise.plans import train as T
from foldwise.plans.program_queries import assay_config
from foldwise.sources import views
from foldwise.sources.views import TARGETS

#: tiny trees, so that all nine candidates fit in a test
TINY = {n: {"trees": 2, "depth": 2} for n in models.CANDIDATES if n not in models.LINEAR}


def test_reference_presets_are_the_default():
    assert assay_config().scale == oof.OOFConfig().scale == "reference"
    lgb, xgb = models.tree_spec("lgb").params, models.tree_spec("xgb").params
    assert (lgb.trees, lgb.leaves, lgb.min_rows, lgb.l2, lgb.patience) == (2000, 31, 20, 1.0, 80)
    assert (xgb.trees, xgb.depth, xgb.l2, xgb.rows, xgb.columns, xgb.patience) == (3000, 6, 1.0, 0.9, 0.9, 80)
    assert models.tree_spec("random_forest").params.trees == 400 and models.tree_spec("extra_trees").params.trees == 500
    hist = models.tree_spec("hist_gbrt")
    assert (hist.final_params.trees, hist.final_params.patience, hist.final_stop_share) == (400, 25, 0.12)


def test_oof_trees_runs_at_the_reference_presets(spark, sf_dir):
    rows = {(r.target, r.model): r for r in registry.queries()["oof_trees"](spark, sf_dir).collect()}
    assert set(rows) == {(t, m) for t in TARGETS for m in models.CANDIDATES if m not in models.LINEAR}
    assert len({r.n for r in rows.values()}) == 1 and all(np.isfinite(r.rmse) for r in rows.values())


def test_adversarial_forest_has_all_trees(spark, sf_dir, monkeypatch):
    seen = []

    def validate(train, test, features, **kw):
        seen.append(kw.get("forest_trees", 200))
        raise Stop

    monkeypatch.setattr(diagnose, "adversarial_validation", validate)
    with pytest.raises(Stop):
        registry.queries()["adversarial_auc"](spark, sf_dir)
    assert seen == [200]


class Stop(Exception):
    pass


@pytest.mark.parametrize("name", ["train_predict", "save_load_roundtrip", "diagnostics_run"])
def test_programs_train_every_candidate(spark, sf_dir, monkeypatch, name):
    seen = []

    def train(spark, df, cfg, fit_final=True):
        seen.append(cfg)
        raise Stop

    monkeypatch.setattr(T, "train", train)
    adversarial = dict.fromkeys(("auc_mean", "auc_std", "auc_folds", "top_logistic", "top_importance", "shifted"))
    monkeypatch.setattr(diagnose, "adversarial_validation", lambda *a, **kw: adversarial)
    with pytest.raises(Stop):
        registry.queries()[name](spark, sf_dir)
    assert seen[0].candidates == models.CANDIDATES


def test_variants_share_folds_and_take_the_best_trial(spark, sf_dir, monkeypatch):
    """All four variants and the whole search, with few rounds."""
    seen, found = [], []
    combine, booster_search = T.combine, search.booster_search
    monkeypatch.setattr(T, "combine", lambda ready, base, cfg: seen.append((cfg, base)) or combine(ready, base, cfg))
    monkeypatch.setattr(search, "booster_search", lambda *a, **kw: found.append(booster_search(*a, **kw)) or found[0])
    rows = Q.run_variants(views.train_part(views.assay(spark, sf_dir)), {"trees": 3})
    assert [r[0] for r in rows] == ["2", "3", "4", "5"] and all(np.isfinite(r[3]) for r in rows)
    assert rows[1][3] <= rows[0][3]  # the same predictions with a searched blend weight
    assert all(c.candidates == models.CANDIDATES for c, _ in seen)
    assert seen[0][1] is seen[1][1] and len(found[0]) == 14
    best = found[0][0]
    assert best["rmse"] == min(t["rmse"] for t in found[0])
    assert seen[3][0].tree_params["lgb"] == {"trees": 3, **search.to_tree_params(best)}
    lgb = [{(r["index"], r.target): r.pred for r in base.where("model = 'lgb'").collect()} for _, base in seen[2:]]
    assert lgb[0].keys() == lgb[1].keys() and lgb[0] != lgb[1]


def test_search_is_sequential_and_seeded():
    space = search.SPACE

    def bowl(trials):  # best at many leaves, a low rate and little l2
        return [abs(t["num_leaves"] - 50) / 35 + (t["learning_rate"] - 0.035) * 20 + abs(np.log(t["lambda_l2"] / 1e-3)) / 10 for t in trials]

    a, b = search.search(bowl, 40, 1), search.search(bowl, 40, 1)
    assert a == b and len(a) == 40 and [t["rmse"] for t in a] == sorted(t["rmse"] for t in a)
    assert all(lo <= t[name] <= hi for t in a for name, (lo, hi) in space.items())
    later = [t["rmse"] for t in a if t["trial"] >= 10]
    assert np.mean(later) < np.mean([t["rmse"] for t in a if t["trial"] < 10])  # it learns
    asked = []
    search.search(lambda trials: asked.append(len(trials)) or [1.0] * len(trials), 14, 3)
    assert asked == [10, 1, 1, 1, 1]


def test_l2_and_leaves_take_effect(spark, sf_dir):
    """The search's parameters reach the trees."""
    from foldwise.plans.model_queries import FEATURES, TARGET_SPECS, fitted_prep, fold_frame

    tr = fold_frame(spark, sf_dir)
    _, per = fitted_prep(tr)
    cfg = oof.OOFConfig(k=5, seed=1)
    spec = models.replace_params(models.tree_spec("lgb"), {"trees": 4})
    got = []
    for overlay in ({}, {"l2": 500.0}, {"leaves": 4}, {"min_rows": 200}):
        o = oof.tree_oof_specs(tr, FEATURES, TARGET_SPECS[:1], per, cfg, [models.replace_params(spec, overlay)])
        got.append({r["index"]: r.pred for r in o.collect()})
    assert all(g.keys() == got[0].keys() for g in got) and all(g != got[0] for g in got[1:])
    with pytest.raises(ValueError, match="unknown tree parameters"):
        models.replace_params(spec, {"maxIter": 3})


def test_queries_follow_their_tables(spark, sf_dir, tmp_path):
    """A second call reads the tables again: no fits held from the first."""
    for t in ("orders", "lineitem", "customer"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    query = registry.queries()["oof_linear"]
    before = {r.n for r in query(spark, str(tmp_path)).collect()}
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.where("o_orderkey % 3 > 0").write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    spark.catalog.refreshByPath(str(tmp_path))
    after = {r.n for r in query(spark, str(tmp_path)).collect()}
    assert len(before) == len(after) == 1 and after.pop() < before.pop()


def test_nine_candidates_meet_blend_and_bundle(spark, sf_dir, tmp_path):
    a = views.assay(spark, sf_dir)
    cfg = assay_config(mode="baseline", cv_strategy="hash", n_folds=2, candidates=models.CANDIDATES, tree_params=TINY)
    res = T.train(spark, views.train_part(a), cfg)
    assert all(set(w) == set(models.CANDIDATES) for w in res.weights.values()) and len(res.final_trees.fits) == 18
    assert all(1 <= m["rounds"] <= 2 for m in res.final_trees.fits)
    T.save(res, spark, str(tmp_path / "bundle"))
    again = T.load(spark, str(tmp_path / "bundle"))
    test = views.test_part(a).drop(*TARGETS)
    d = diagnose.submission_diff(T.predict(res, test), T.predict(again, test), list(TARGETS)).first()
    assert d.n_unmatched == 0 and d.max_abs_diff < 1e-9


def test_second_sessions_have_no_larger_partitions(spark):
    """three partitions for any input made a task read a third of it."""
    from foldwise.plans import diag_queries

    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = [int(diag_queries._session_of(spark, more).conf.get("spark.sql.shuffle.partitions")) for more in (3, 8)]
    assert min(counts) > own and len({own, *counts}) == 3
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == own
