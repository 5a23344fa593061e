import math

import pytest
from pyspark.sql import functions as F

from foldwise.functions import exprs
from foldwise.sources import files, sinks


def test_bounded_inverse_and_sanitize(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (100.0,), (-5.0,), (3.0,), (None,)], "p double")
    out = df.select(exprs.inverse_bounded("p", True).alias("lg"), exprs.inverse_bounded("p", False).alias("ln"),
                    exprs.sanitize_scaled("p").alias("s")).collect()
    assert out[0].ln == 0.0 and out[0].s == 0.0 and out[0].lg == pytest.approx(1e-9)    # NaN -> 0 -> expm1(0) floored
    assert out[1].s == 0.0
    assert out[2].lg == pytest.approx(50000.0) and out[2].ln == 100.0 and out[2].s == 15.0
    assert out[3].lg == pytest.approx(1e-9) and out[3].ln == 0.0 and out[3].s == -5.0
    assert out[4].lg == pytest.approx(math.expm1(3.0))
    assert out[5].s == 0.0


def test_log_target_and_floored_inverse(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (9.0,), (None,)], "y double")
    r = df.select(exprs.log_target("y").alias("t"), exprs.inverse_floored(exprs.log_target("y")).alias("b")).collect()
    assert [x.t for x in r[:3]] == [0.0, 0.0, pytest.approx(math.log(10.0))]
    assert r[0].b == pytest.approx(1e-9) and r[2].b == pytest.approx(9.0) and r[3].t is None and r[3].b is None


def test_resolve_path_and_json_doc(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "train.csv").write_text("a\n1\n")
    got = files.resolve_path(spark, "train.csv", [str(tmp_path / "missing"), str(tmp_path / "data")])
    assert got is not None and got.endswith("data/train.csv")
    assert files.resolve_path(spark, "nope.csv", [str(tmp_path)]) is None
    sinks.write_json_doc(spark, {"num_leaves": 31, "lr": 0.05}, str(tmp_path / "params"))
    assert sinks.read_json_doc(spark, str(tmp_path / "params")) == {"num_leaves": 31, "lr": 0.05}


def test_feature_set_diff(spark):
    a = spark.createDataFrame([(1, 1.0, 2.0, "x")], "index long, f1 double, f2 double, s string")
    b = spark.createDataFrame([(1, 1.0, 3)], "index long, f1 double, f3 int")
    assert files.feature_set_diff(a, b, ["index"]) == (["f2"], ["f3"])


def test_cut_lineage_spread_only_when_rows_fill_more_partitions(spark):
    from foldwise.session import MIN_ROWS_PER_PARTITION, cut_lineage

    cores = spark.sparkContext.defaultParallelism
    big = spark.range(0, MIN_ROWS_PER_PARTITION * 4, numPartitions=1).withColumn("v", F.col("id") * 2)
    spread = cut_lineage(big, spread=True)
    assert spread.rdd.getNumPartitions() == min(cores, 4) or cores < 2
    assert spread.agg(F.count(F.lit(1)), F.sum("v")).first() == (MIN_ROWS_PER_PARTITION * 4, sum(range(0, MIN_ROWS_PER_PARTITION * 4)) * 2)
    small = spark.range(0, 100, numPartitions=1)
    assert cut_lineage(small, spread=True).rdd.getNumPartitions() == 1
    assert cut_lineage(big).rdd.getNumPartitions() == 1
