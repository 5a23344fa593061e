import pytest
from pyspark.sql import functions as F

from foldwise.functions.features import add_domain_features

ROW = dict(MolLogP=1.5, TPSA=40.0, HeavyAtomCount=22.0, NumAromaticRings=2.0, MaxPartialCharge=0.12,
           MinPartialCharge=-0.2, fr_imide=0.0, fr_sulfone=2.0, RingCount=3.0, FractionCSP3=0.5)


def test_derived_columns_and_flags(spark):
    df = spark.createDataFrame([tuple(ROW.values())], ", ".join(f"{k} double" for k in ROW))
    r = add_domain_features(df).first().asDict()
    for c in ("LogP_TPSA", "Arom_Heavy_ratio", "Charge_sum", "fr_imide_flag", "fr_sulfone_flag", "Ring_LogP", "FractionCSP3_LogP"):
        assert c in r
    assert r["fr_imide_flag"] == 0.0 and r["fr_sulfone_flag"] == 1.0
    assert r["LogP_TPSA"] == pytest.approx(1.5 / (40 + 1e-6))
    assert r["Arom_Heavy_ratio"] == pytest.approx(2 / (22 + 1e-6))
    assert r["Charge_sum"] == pytest.approx(-0.08)
    assert r["Ring_LogP"] == pytest.approx(4.5) and r["FractionCSP3_LogP"] == pytest.approx(0.75)


def test_absent_inputs_skipped_and_fallback(spark):
    df = spark.createDataFrame([(1.0, 3.0, 10.0)], "MolLogP double, fr_benzene double, HeavyAtomCount double")
    out = add_domain_features(df)
    assert "LogP_TPSA" not in out.columns and "Charge_sum" not in out.columns
    assert out.first()["Arom_Heavy_ratio"] == pytest.approx(3 / (10 + 1e-6))


def test_null_flag_is_zero_and_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(None, 1.0, -1e-6)], "fr_imide double, MolLogP double, TPSA double")
    r = add_domain_features(df).first()
    assert r["fr_imide_flag"] == 0.0
    assert r["LogP_TPSA"] is None
