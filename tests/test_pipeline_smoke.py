import numpy as np

from foldwise.plans import train as T
from foldwise.plans.program_queries import assay_config
from foldwise.sources import views
from foldwise.sources.views import TARGETS


def test_train_predict_smoke(spark, sf_dir):
    a = views.assay(spark, sf_dir)
    res = T.train(spark, views.train_part(a), assay_config(cv_strategy="hash", si_blend=True))
    test = views.test_part(a).drop(*TARGETS)
    sub = T.predict(res, test)
    assert sub.columns == ["index", "t1", "t2", "t3"]
    assert sub.count() == test.count()
    pdf = sub.toPandas()
    assert (pdf[["t1", "t2"]] >= 1e-8).all().all() and (pdf["t3"] >= 0).all()
    assert np.isfinite(res.metrics["oof_score"])


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["target", "n", "rmse"] and df.count() == 4
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 50
