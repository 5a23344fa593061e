"""pyspark.ml stages of the library, and a caller's estimators inside a run."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from foldwise.operators import diagnose, prep, stages
from foldwise.plans import train as T
from foldwise.plans.program_queries import assay_config
from foldwise.sources import views
from foldwise.sources.views import TARGETS


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = np.exp(1 + 0.5 * x[:, 0]) + 0.01 * rng.random(200)
    data = [(i, None if i % 7 == 0 else float(a), float(b), 1.0, float(t)) for i, ((a, b, _), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "index long, a double, b double, k double, y double")


def test_saved_pipeline_predicts_the_same(spark, rows, tmp_path):
    pre = stages.Preprocessor(exclude=["index", "y"], outputCol="v")
    reg = stages.LogTargetRegressor(LinearRegression(featuresCol="v", labelCol="y"))
    pipeline = Pipeline(stages=[pre, reg])
    pipeline.write().overwrite().save(str(tmp_path / "p"))
    model = Pipeline.load(str(tmp_path / "p")).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (m.transform(rows).orderBy("index").toPandas() for m in (model, again))
    assert a.prediction.tolist() == b.prediction.tolist() and (a.y == rows.orderBy("index").toPandas().y).all()
    plain = prep.fit(rows, exclude=["index", "y"])
    assert again.stages[0].model.features == plain.features == ["a", "b"]
    want = plain.transform(rows, ["index"]).orderBy("index").toPandas()
    assert np.allclose(np.array([list(v) for v in b.v]), want[["a", "b"]].to_numpy())
    # the wrapper: a fit on log1p(y), brought back by expm1
    inner = LinearRegression(featuresCol="v", labelCol="z").fit(again.stages[0].transform(rows).withColumn("z", F.log1p("y")))
    hand = inner.transform(again.stages[0].transform(rows)).orderBy("index").toPandas()
    assert np.allclose(np.expm1(hand.prediction), b.prediction, rtol=1e-6)
    with pytest.raises(ValueError, match="missing fitted features"):
        again.stages[0].transform(rows.drop("a"))


def test_a_callers_estimators_run_through_train(spark, sf_dir, tmp_path):
    a = views.assay(spark, sf_dir)
    own = {"tree": DecisionTreeRegressor(maxDepth=3, seed=1), "linear": LinearRegression(regParam=0.1)}
    test = views.test_part(a).drop(*TARGETS)
    for mode in ("stacking", "baseline"):
        cfg = assay_config(mode=mode, cv_strategy="hash", n_folds=3, candidates=("ridge",))
        res = T.train(spark, views.train_part(a), cfg, estimators=own)
        assert res.names == ["ridge", "tree", "linear"] and len(res.extra) == 6
        assert {k.split("/")[1] for k in res.metrics["base_rmse"]} == set(res.names)
        T.save(res, spark, str(tmp_path / mode))
        again = T.load(spark, str(tmp_path / mode))
        pred = T.predict(res, test)
        d = diagnose.submission_diff(pred, T.predict(again, test), list(TARGETS)).first()
        assert d.n_unmatched == 0 and d.max_abs_diff < 1e-9
    with pytest.raises(ValueError, match="names of candidates"):
        T.train(spark, views.train_part(a), cfg, estimators={"ridge": own["tree"]})
