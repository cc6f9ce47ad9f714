"""Regression quality in a single aggregate: one scoring pass feeds every figure."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.functions.rounding import round_exact

# Tolerances reported, in dollars.
TOLERANCES = (1, 2, 5)


def _share(tolerance: int) -> str:
    return f"percentage_within_{tolerance}_dollar"


def regression_metrics(
    df: DataFrame,
    label: str = S.LABEL,
    prediction: str = S.PREDICTION,
    tolerances: Sequence[int] = TOLERANCES,
) -> DataFrame:
    """One row: record count, rmse, r2, mae and the shares within each tolerance."""
    error = F.col(prediction) - F.col(label)
    squared = error * error
    total_variation = F.var_pop(label) * F.count(label)
    return df.agg(
        F.count(F.lit(1)).alias("test_records"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(squared), total_variation)).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        *[
            F.try_divide(F.lit(100.0) * F.count_if(F.abs(error) <= t), F.count(F.lit(1))).alias(_share(t))
            for t in tolerances
        ],
    )


def evaluation_record(metrics: DataFrame, tolerances: Sequence[int] = TOLERANCES) -> DataFrame:
    """The stored form of the metrics: time stamp first, figures rounded."""
    return metrics.select(
        F.date_format(F.current_timestamp(), S.SECOND_FORMAT).alias("timestamp"),
        "test_records",
        *[round_exact(F.col(c), 4).alias(c) for c in ("rmse", "r2", "mae")],
        *[round_exact(F.col(_share(t)), 2).alias(_share(t)) for t in tolerances],
    )
