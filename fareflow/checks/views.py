"""Deterministic trip and run-log views over the given tables.

Each expression is valid in Spark SQL and in the SQL of the check, so both sides
start from the same rows. The views contain every case the rules must handle.
"""

from pyspark.sql import DataFrame, SparkSession

TRIPS = {
    "trip_id": "event_id",
    "tpep_pickup_datetime": "ts",
    "trip_distance": "CASE WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value / 5 END",
    "passenger_count": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id % 8 END",
    "PULocationID": "user_id",
    "DOLocationID": "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)",
    "fare_amount": "CASE WHEN event_id % 97 = 0 THEN -3.0 ELSE 3.0 + 2.5 * value / 5 + 0.01 * user_id END",
}

# Line items give volume and every month of seven years; their fare is not learnable.
LINE_TRIPS = {
    "tpep_pickup_datetime": "l_shipdate",
    "trip_distance": "l_quantity",
    "passenger_count": "CAST(l_linenumber AS BIGINT)",
    "PULocationID": "l_suppkey",
    "DOLocationID": "l_partkey",
    "fare_amount": "l_extendedprice / 1000",
}

RUN_ID = "concat('query_', CAST(event_id AS VARCHAR(20)))"

RUN_LOG = {
    "timestamp": "substr(CAST(ts AS VARCHAR(30)), 1, 19)",
    "query_id": RUN_ID,
    "input": "concat(event_type, '.parquet')",
    "duration_seconds": "value",
    "success": "event_id % 20 <> 0",
    "config": "CASE WHEN event_type = 'error' THEN 'default' ELSE concat('config_', event_type) END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()])


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "events", TRIPS)


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "lineitem", LINE_TRIPS)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "events", RUN_LOG)


def as_sql(name: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{sql} AS {c}' for c, sql in columns.items())} FROM {name}"


CALENDAR_SQL = """CAST(hour(tpep_pickup_datetime) AS INTEGER) AS "hour",
  CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week,
  CAST(month(tpep_pickup_datetime) AS INTEGER) AS "month" """

TYPED_SQL = """CAST(trip_distance AS DOUBLE) AS trip_distance, PULocationID, DOLocationID,
  CAST(passenger_count AS DOUBLE) AS passenger_count"""

VALID_SQL = """trip_distance > 0 AND NOT isnan(trip_distance)
  AND passenger_count > 0 AND passenger_count <= 6
  AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND tpep_pickup_datetime IS NOT NULL"""

FARE_VALID_SQL = "fare_amount > 0 AND fare_amount < 150"


def trips_sql() -> str:
    return as_sql("events", TRIPS)


def cleaned_sql(source: str | None = None, labelled: bool = True, extra: str = "") -> str:
    source = source or trips_sql()
    fare = ", CAST(fare_amount AS DOUBLE) AS fare_amount" if labelled else ""
    fare_rule = f" AND {FARE_VALID_SQL}" if labelled else ""
    return f"""SELECT {TYPED_SQL},
  {CALENDAR_SQL}{fare}{extra}
FROM ({source}) AS trips
WHERE {VALID_SQL}{fare_rule}"""
