"""Table contracts and the fixed values the jobs agree on."""

from pyspark.sql import types as T

# Column names, their order and their types are the data contract.
PICKUP = "tpep_pickup_datetime"
LABEL = "fare_amount"
PREDICTION = "prediction"
FEATURE_COLUMNS = (
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "hour",
    "day_of_week",
    "month",
)
CLEANED_COLUMNS = (*FEATURE_COLUMNS, LABEL)
PREDICTION_COLUMNS = (
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    PREDICTION,
)
TRIP_TYPES = {
    PICKUP: "timestamp",
    "trip_distance": "double",
    "passenger_count": "double",
    LABEL: "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
}

# The cleaning rules. (column, operator, bound)
TRIP_RULES = (
    ("trip_distance", ">", 0),
    ("passenger_count", ">", 0),
    ("passenger_count", "<=", 6),
)
FARE_RULES = (
    (LABEL, ">", 0),
    (LABEL, "<", 150),
)

# Formats and names used in the stored logs and paths.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FILE_PATTERN = "yellow_tripdata_{year}-{month:02d}.parquet"
LOAD_TEST_PREFIX = "config_"
DEFAULT_CONFIG = "default"

CLEANED = T.StructType(
    [
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField(LABEL, T.DoubleType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField(PREDICTION, T.DoubleType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("config", T.StringType()),
    ]
)

# Name of the folder beside the runs that says what became of each; scans pass over it.
MANIFEST = "_submissions"
SUBMISSIONS = T.StructType(
    [
        T.StructField("submission", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("finished", T.TimestampType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("config", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("valid_rows", T.LongType()),
        T.StructField("scored_rows", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("problem", T.StringType()),
    ]
)


def trip_columns(labelled: bool) -> tuple[str, ...]:
    """Raw columns a job needs; only labelled trips carry a fare."""
    return tuple(c for c in TRIP_TYPES if labelled or c != LABEL)
