"""Fitting and judging the fare model."""

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from fareflow.operators.metrics import regression_metrics
from fareflow.operators.model import fit_fares, predict, save_model
from fareflow.operators.split import hash_split
from fareflow.plans.preprocess import preprocess_paths
from fareflow.sources.tables import read_cleaned
from fareflow.sources.trips import read_clean_trips


def train_on_cleaned(
    cleaned: DataFrame, model_path: str | None = None, train_percent: int = 80, **params
) -> tuple[PipelineModel, DataFrame]:
    """(model, one-row metrics on the held-out share); the metrics are lazy."""
    train, test = hash_split(cleaned, train_percent)
    model = fit_fares(train, **params)
    if model_path:
        save_model(model, model_path)
    return model, regression_metrics(predict(model, test))


def train_on_raw(
    spark: SparkSession,
    paths: Sequence[str],
    model_path: str | None = None,
    cleaned_path: str | None = None,
    format: str | None = None,
    **params,
) -> tuple[PipelineModel, DataFrame]:
    """As above, from raw files.

    Fitting passes over its input several times. With `cleaned_path` the cleaned
    rows are written there first, so those passes read eight typed columns and a
    lost executor re-reads them instead of cleaning raw files again.
    """
    if cleaned_path:
        preprocess_paths(spark, paths, cleaned_path, format=format)
        cleaned = read_cleaned(spark, cleaned_path)
    else:
        cleaned = read_clean_trips(spark, paths, labelled=True, format=format)
    return train_on_cleaned(cleaned, model_path, **params)
