"""Split, metrics, rounding."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.functions.rounding import fixed_text, right_align, round_exact, round_scaled
from fareflow.operators.metrics import evaluation_record, regression_metrics
from fareflow.operators.split import hash_split


@pytest.fixture(scope="module")
def cleaned(spark):
    return spark.createDataFrame(
        [(random.Random(i).random() * 20, i % 263, i % 131, 1.0 + i % 6, i % 24, 1 + i % 7, 1 + i % 12,
          3 + random.Random(-i).random() * 50) for i in range(5000)],
        S.CLEANED,
    )


def test_split_is_disjoint_and_whole(cleaned):
    train, test = hash_split(cleaned)
    assert train.count() + test.count() == 5000
    assert train.intersect(test).isEmpty()
    assert 0.17 < test.count() / 5000 < 0.23


def test_split_does_not_depend_on_partitioning(cleaned):
    sides = [sorted(hash_split(cleaned.repartition(n))[1].collect()) for n in (1, 3, 16)]
    assert sides[0] == sides[1] == sides[2]


def test_equal_rows_share_a_side(cleaned):
    copies = cleaned.limit(1).crossJoin(cleaned.sparkSession.range(500)).drop("id").unionByName(cleaned)
    train, test = hash_split(copies)
    assert train.intersect(test).isEmpty()
    assert train.count() + test.count() == 5500


def test_split_bounds(cleaned):
    with pytest.raises(ValueError):
        hash_split(cleaned, train_percent=101)
    assert hash_split(cleaned, train_percent=100)[1].isEmpty()


def test_metrics_equal_the_evaluator(cleaned):
    scored = cleaned.withColumn("prediction", F.lit(3.0) + F.col("trip_distance") * 2.5)
    row = regression_metrics(scored).first()
    for name in ("rmse", "r2", "mae"):
        expected = RegressionEvaluator(labelCol=S.LABEL, metricName=name).evaluate(scored)
        assert row[name] == pytest.approx(expected, rel=1e-12)
    for k in (1, 2, 5):
        within = scored.filter(F.abs(F.col("prediction") - F.col(S.LABEL)) <= k).count()
        assert row[f"percentage_within_{k}_dollar"] == pytest.approx(100 * within / 5000)


def test_metrics_of_nothing(cleaned):
    row = regression_metrics(cleaned.filter("false").withColumn("prediction", F.lit(1.0))).first()
    assert row.test_records == 0 and row.rmse is None and row.r2 is None


def test_tolerance_is_inclusive(spark):
    df = spark.createDataFrame([(10.0, 11.0), (10.0, 8.0), (10.0, 15.0), (10.0, 15.5)], "fare_amount double, prediction double")
    row = regression_metrics(df).first()
    assert [row[f"percentage_within_{k}_dollar"] for k in (1, 2, 5)] == [25.0, 50.0, 75.0]


def test_metrics_take_one_scan(cleaned):
    plan = regression_metrics(cleaned.withColumn("prediction", F.lit(1.0)))._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange SinglePartition") == 1


def test_evaluation_record(cleaned):
    record = evaluation_record(regression_metrics(cleaned.withColumn("prediction", F.lit(1.0))))
    assert record.columns == [
        "timestamp", "test_records", "rmse", "r2", "mae",
        "percentage_within_1_dollar", "percentage_within_2_dollar", "percentage_within_5_dollar",
    ]
    assert len(record.first().timestamp) == 19


def test_rounding_follows_python_and_numpy(spark):
    rng = random.Random(7)
    ties = [0.05, 0.15, 0.25, 2.675, 1.005, 2.125, 0.125, 103.585, 1234567.125, 0.0, -2.5, -0.125]
    values = ties + [rng.uniform(-200, 200) for _ in range(500)] + [round(rng.random() * 99, 3) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", fixed_text(F.col("v"), 1).alias("one"), round_exact(F.col("v"), 2).alias("exact"),
        round_scaled(F.col("v"), 2).alias("even"), right_align(fixed_text(F.col("v"), 2), 4).alias("padded"),
    )
    for r in df.collect():
        assert r.one == f"{r.v:.1f}"
        assert r.exact == round(r.v, 2)
        assert r.even == np.round(r.v, 2)
        assert r.padded == f"{r.v:>4.2f}"
