"""Queries over stored predictions, made by the surrogate predictor so SQL can state them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.checks import views as V
from fareflow.checks.trips import surrogate
from fareflow.operators.features import clean_trips
from fareflow.operators.results import (
    preview,
    read_result_text,
    readable_rows,
    result_catalogue,
    rows_per_run,
    stored_runs,
)
from fareflow.session import scratch_path
from fareflow.sources.tables import (
    export_predictions,
    read_predictions,
    read_predictions_by_run,
    write_predictions,
    write_predictions_by_run,
)

# One run per weekday and passenger count; counts outside the rules leave runs without a result.
RUN = "concat('query_', dayname(tpep_pickup_datetime), '_', coalesce(CAST(passenger_count AS VARCHAR(5)), 'none'))"

WHOLE = "query_whole"


def _run_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.event_trips(spark, sf_dir).withColumn("query_id", F.expr(RUN))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate(clean_trips(_run_trips(spark, sf_dir), labelled=False, keep=["query_id"]))


def result_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "results")
    write_predictions_by_run(_scored(spark, sf_dir), root)
    return result_catalogue(_run_trips(spark, sf_dir), stored_runs(spark, root))


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "results")
    write_predictions_by_run(_scored(spark, sf_dir), root, format="parquet")
    return rows_per_run(read_predictions_by_run(spark, root, format="parquet"))


def _whole_run(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "results")
    write_predictions(_scored(spark, sf_dir), f"{root}/query_id={WHOLE}")
    return root


def result_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _whole_run(spark, sf_dir)
    text = read_result_text(spark, f"{root}/query_id={WHOLE}")
    order = [F.desc(S.PREDICTION), "PULocationID", "DOLocationID", "passenger_count"]
    return preview(text, rows=20, order_by=order)


def result_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored text with unreadable and missing fields: what is left to show."""
    scored = surrogate(clean_trips(_run_trips(spark, sf_dir), labelled=False, keep=["trip_id"]))
    spoilt = {
        S.PREDICTION: "CASE WHEN trip_id % 31 = 0 THEN 'abc' ELSE CAST(prediction AS STRING) END",
        "passenger_count": "CASE WHEN trip_id % 37 = 0 THEN NULL ELSE CAST(passenger_count AS STRING) END",
    }
    text = scored.withColumns({c: F.expr(sql) for c, sql in spoilt.items()})
    columns = [F.col(c).cast("string") for c in S.PREDICTION_COLUMNS]
    return readable_rows(text.select(*columns))


def result_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _whole_run(spark, sf_dir)
    export_predictions(spark, root, WHOLE, f"{root}/export")
    return read_predictions(spark, f"{root}/export/{WHOLE}_results.csv")


def result_export_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same export when the result is over the single-file size."""
    root = _whole_run(spark, sf_dir)
    export_predictions(spark, root, WHOLE, f"{root}/export", single_file=False)
    return read_predictions(spark, f"{root}/export/{WHOLE}_results.csv")


QUERIES = {
    "result_catalog": result_catalog,
    "result_rows": result_rows,
    "result_preview": result_preview,
    "result_readable": result_readable,
    "result_export": result_export,
    "result_export_parts": result_export_parts,
}

_RUN_NAME_SQL = """concat('query_', substr(dayname(tpep_pickup_datetime), 1, 3), '_',
  coalesce(CAST(passenger_count AS VARCHAR), 'none'))"""

_RUNS_SQL = f"SELECT *, {_RUN_NAME_SQL} AS query_id FROM ({V.trips_sql()}) AS trips"

_KEPT_SQL = V.cleaned_sql(_RUNS_SQL, labelled=False, extra=", query_id, trip_id")

_SCORED_SQL = f"""SELECT trip_distance, PULocationID, DOLocationID, passenger_count,
  3.0::DOUBLE + 2.5::DOUBLE * trip_distance AS prediction, query_id, trip_id FROM ({_KEPT_SQL}) AS kept"""

_STORED_SQL = f"""SELECT trip_distance, PULocationID, DOLocationID, passenger_count, prediction
FROM ({_SCORED_SQL}) AS scored"""

ORACLES = {
    "result_catalog": f"""SELECT query_id,
  CASE WHEN count(*) FILTER ({V.VALID_SQL}) > 0 THEN 'complete' ELSE 'no results' END AS status
FROM ({_RUNS_SQL}) AS runs GROUP BY query_id ORDER BY query_id""",
    "result_rows": f'SELECT query_id, count(*) AS "rows" FROM ({_SCORED_SQL}) AS scored GROUP BY query_id',
    "result_preview": f"""SELECT printf('%10.1f', trip_distance) AS distance,
  lpad(CAST(PULocationID AS VARCHAR), 12, ' ') AS pickup_zone,
  lpad(CAST(DOLocationID AS VARCHAR), 13, ' ') AS dropoff_zone,
  lpad(CAST(passenger_count AS VARCHAR), 11, ' ') AS passengers,
  printf('$%14.2f', prediction) AS predicted_fare
FROM ({_STORED_SQL}) AS stored
ORDER BY prediction DESC, CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR), passenger_count
LIMIT 20""",
    "result_readable": f"""SELECT trip_distance, CAST(PULocationID AS VARCHAR) AS PULocationID,
  CAST(DOLocationID AS VARCHAR) AS DOLocationID, CAST(passenger_count AS VARCHAR) AS passenger_count, prediction
FROM ({_SCORED_SQL}) AS scored WHERE trip_id % 31 <> 0 AND trip_id % 37 <> 0""",
    "result_export": _STORED_SQL,
    "result_export_parts": _STORED_SQL,
}
