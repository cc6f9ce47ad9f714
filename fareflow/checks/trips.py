"""Queries over typing, cleaning, reading, writing and splitting trips."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.checks import views as V
from fareflow.operators.features import clean_trips, typed_trips, valid_trips, with_calendar
from fareflow.operators.metrics import evaluation_record, regression_metrics
from fareflow.operators.split import hash_split
from fareflow.plans.preprocess import preprocess_months, preprocess_paths
from fareflow.session import scratch_path
from fareflow.sources.tables import read_cleaned, write_record
from fareflow.sources.trips import read_clean_trips, read_trips

KEY = ["trip_id"]

# Text as users submit it: whole numbers with a decimal part, and unreadable fields.
TEXT_TRIPS = {
    "trip_id": "trip_id",
    "tpep_pickup_datetime": "CASE WHEN trip_id % 83 = 0 THEN 'notadate' ELSE CAST(tpep_pickup_datetime AS STRING) END",
    "trip_distance": "CASE WHEN trip_id % 89 = 0 THEN 'abc' ELSE CAST(trip_distance AS STRING) END",
    "passenger_count": "CAST(passenger_count AS STRING)",
    "PULocationID": "concat(CAST(PULocationID AS STRING), CASE WHEN trip_id % 2 = 0 THEN '.0' ELSE '' END)",
    "DOLocationID": "CAST(DOLocationID AS STRING)",
    "fare_amount": "CAST(fare_amount AS STRING)",
}

# What that text means, stated on the typed view.
MEANT_TRIPS = {
    "trip_id": "trip_id",
    "tpep_pickup_datetime": "CASE WHEN trip_id % 83 = 0 THEN NULL ELSE tpep_pickup_datetime END",
    "trip_distance": "CASE WHEN trip_id % 89 = 0 THEN NULL ELSE trip_distance END",
    "passenger_count": "passenger_count",
    "PULocationID": "PULocationID",
    "DOLocationID": "DOLocationID",
    "fare_amount": "fare_amount",
}


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = V.event_trips(spark, sf_dir)
    return trips.selectExpr(*[f"{sql} AS {c}" for c, sql in TEXT_TRIPS.items()])


def meant_sql() -> str:
    columns = ", ".join(f"{sql} AS {c}" for c, sql in MEANT_TRIPS.items())
    return f"SELECT {columns} FROM ({V.trips_sql()}) AS typed"


def trip_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typing alone: unreadable text becomes NULL and the row stays."""
    typed = typed_trips(text_trips(spark, sf_dir), labelled=True, keep=KEY)
    not_a_number = F.isnan("trip_distance")
    return typed.withColumns(
        {
            "distance_is_nan": F.coalesce(not_a_number, F.lit(False)),
            "trip_distance": F.when(~not_a_number, F.col("trip_distance")),
            S.PICKUP: F.date_format(S.PICKUP, S.SECOND_FORMAT),
        }
    )


def _calendar(trips: DataFrame) -> DataFrame:
    parts = ("hour", "day_of_week", "month")
    return with_calendar(trips).groupBy(*parts).agg(F.count(F.lit(1)).alias("trips"))


def trip_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = V.event_trips(spark, sf_dir)
    return with_calendar(trips).select("trip_id", "hour", "day_of_week", "month")


def trip_time_features_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar(V.line_trips(spark, sf_dir))


def trip_filter_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_trips(V.event_trips(spark, sf_dir), labelled=True).select(
        *KEY, "trip_distance", "passenger_count", F.col("fare_amount").cast("double")
    )


def clean_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(V.event_trips(spark, sf_dir), labelled=True, keep=KEY)


def clean_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(V.event_trips(spark, sf_dir), labelled=False, keep=KEY)


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", "true").csv(path)
    return path


def _text_halves(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """The text trips as two CSV inputs: other column orders, letter case and extra columns."""
    text = text_trips(spark, sf_dir)
    odd = F.col("trip_id") % 2 == 1
    forward = [c for c in TEXT_TRIPS if c != "trip_id"]
    renamed = [F.col(c).alias(c.lower()) for c in reversed(forward)]
    return [
        _write_csv(text.filter(odd).select(*forward), f"{root}/forward.csv"),
        _write_csv(text.filter(~odd).select("trip_id", *renamed), f"{root}/backward.csv"),
    ]


def csv_intake_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _text_halves(spark, sf_dir, scratch_path(spark, "csv-intake"))
    return read_clean_trips(spark, paths, labelled=False)


def csv_intake_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the uncleaned read: nothing is dropped before the rules."""
    paths = _text_halves(spark, sf_dir, scratch_path(spark, "csv-typed"))
    return read_trips(spark, paths, labelled=False).agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.count(c).alias(f"{c}_read") for c in ("trip_distance", "passenger_count", S.PICKUP)],
        *[F.sum(c).alias(f"{c}_sum") for c in ("PULocationID", "DOLocationID")],
    )


def drifting_months(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Line items as monthly folders whose column types change with the year."""
    trips = V.line_trips(spark, sf_dir).withColumn("part", F.date_format(S.PICKUP, "yyyy-MM"))
    late = F.year(S.PICKUP) >= 1998
    early_types = {"PULocationID": "double", "DOLocationID": "int"}
    late_types = {"passenger_count": "double", "trip_distance": "bigint"}
    for side, types in ((~late, early_types), (late, late_types)):
        slices = trips.filter(side).withColumns({c: F.col(c).cast(t) for c, t in types.items()})
        slices.hint("rebalance", "part").write.mode("append").partitionBy("part").parquet(root)


def month_years(spark: SparkSession, sf_dir: str) -> range:
    shipped = V.table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("y"))
    first, last = shipped.agg(F.min("y"), F.max("y")).first()
    return range(first, last + 1)


MONTH_FOLDER = "part={year}-{month:02d}"


def monthly_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "months")
    drifting_months(spark, sf_dir, f"{root}/raw")
    years = month_years(spark, sf_dir)
    preprocess_months(spark, f"{root}/raw", years, f"{root}/cleaned", pattern=MONTH_FOLDER)
    return read_cleaned(spark, f"{root}/cleaned")


def monthly_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The by-month layout, read back through its year folders."""
    root = scratch_path(spark, "by-month")
    drifting_months(spark, sf_dir, f"{root}/raw")
    years = month_years(spark, sf_dir)
    preprocess_months(
        spark, f"{root}/raw", years, f"{root}/cleaned", pattern=MONTH_FOLDER, by_month=True
    )
    cleaned = read_cleaned(spark, f"{root}/cleaned", years=years)
    return cleaned.groupBy("month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("PULocationID").alias("zones")
    )


def cleaned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Parquet input, cleaned, written and read back with its fixed schema."""
    root = scratch_path(spark, "round-trip")
    V.event_trips(spark, sf_dir).write.parquet(f"{root}/raw.parquet")
    preprocess_paths(spark, [f"{root}/raw.parquet"], f"{root}/cleaned")
    return read_cleaned(spark, f"{root}/cleaned")


def portable_bucket() -> Column:
    """A bucket both engines compute alike; jobs use the default row hash."""
    return F.pmod(F.col("trip_id") * 7919 + 104729, F.lit(100))


def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_labelled(spark, sf_dir)
    train, test = hash_split(cleaned, bucket=portable_bucket())
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_id").alias("trip_id_sum")
    )


def hash_split_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-hash split keeps every row once and puts equal rows on one side."""
    train, test = hash_split(clean_labelled(spark, sf_dir).drop("trip_id"))
    sides = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    rows = sides.groupBy(*S.CLEANED_COLUMNS).agg(
        F.count(F.lit(1)).alias("copies"), F.min("side").alias("first"), F.max("side").alias("last")
    )
    return rows.agg(
        F.sum("copies").alias("trips"), F.count_if(F.col("first") != F.col("last")).alias("rows_on_both_sides")
    )


def surrogate(cleaned: DataFrame) -> DataFrame:
    """A predictor any engine can evaluate, standing in for the trees."""
    return cleaned.withColumn(S.PREDICTION, F.lit(3.0) + F.lit(2.5) * F.col("trip_distance"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression_metrics(surrogate(clean_labelled(spark, sf_dir)))


def regression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = metrics(spark, sf_dir)
    return raw.select("test_records", *[F.bround(c, 6).alias(c) for c in raw.columns[1:]])


def metrics_record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    record = evaluation_record(metrics(spark, sf_dir))
    write_record(record, path)
    return spark.read.schema(record.schema).json(path).drop("timestamp")


QUERIES = {
    "trip_typed_projection": trip_typed_projection,
    "trip_time_features": trip_time_features,
    "trip_time_features_months": trip_time_features_months,
    "trip_filter_labelled": trip_filter_labelled,
    "clean_labelled": clean_labelled,
    "clean_unlabelled": clean_unlabelled,
    "csv_intake_clean": csv_intake_clean,
    "csv_intake_typed": csv_intake_typed,
    "monthly_union": monthly_union,
    "monthly_partitions": monthly_partitions,
    "cleaned_round_trip": cleaned_round_trip,
    "hash_split_counts": hash_split_counts,
    "hash_split_whole": hash_split_whole,
    "regression_metrics": regression_quality,
    "metrics_record_json": metrics_record_json,
}

_LINE_TRIPS_SQL = V.as_sql("lineitem", V.LINE_TRIPS)

_ERRORS_SQL = f"""SELECT fare_amount, (3.0::DOUBLE + 2.5::DOUBLE * trip_distance) - fare_amount AS e
FROM ({V.cleaned_sql()}) AS cleaned"""

_SHARES_SQL = {
    t: f"100.0::DOUBLE * count(*) FILTER (abs(e) <= {t}) / count(*)" for t in (1, 2, 5)
}
_QUALITY_SQL = {
    "rmse": "sqrt(avg(e * e))",
    "r2": "1 - sum(e * e) / (var_pop(fare_amount) * count(*))",
    "mae": "avg(abs(e))",
}


def _quality_sql(quality: str, share: str) -> str:
    columns = [f"{quality.format(sql)} AS {c}" for c, sql in _QUALITY_SQL.items()]
    columns += [f"{share.format(sql)} AS percentage_within_{t}_dollar" for t, sql in _SHARES_SQL.items()]
    return f"SELECT count(*) AS test_records, {', '.join(columns)} FROM ({_ERRORS_SQL}) AS errors"


ORACLES = {
    "trip_typed_projection": f"""SELECT trip_id,
  strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
  CASE WHEN isnan(trip_distance) THEN NULL ELSE trip_distance END AS trip_distance,
  coalesce(isnan(trip_distance), FALSE) AS distance_is_nan,
  CAST(passenger_count AS DOUBLE) AS passenger_count, CAST(fare_amount AS DOUBLE) AS fare_amount,
  PULocationID, DOLocationID
FROM ({meant_sql()}) AS trips""",
    "trip_time_features": f"SELECT trip_id, {V.CALENDAR_SQL} FROM ({V.trips_sql()}) AS trips",
    "trip_time_features_months": f"""SELECT "hour", day_of_week, "month", count(*) AS trips
FROM (SELECT {V.CALENDAR_SQL} FROM ({_LINE_TRIPS_SQL}) AS trips) AS parts
GROUP BY "hour", day_of_week, "month" """,
    "trip_filter_labelled": f"""SELECT trip_id, trip_distance, passenger_count,
  CAST(fare_amount AS DOUBLE) AS fare_amount
FROM ({V.trips_sql()}) AS trips WHERE {V.VALID_SQL} AND {V.FARE_VALID_SQL}""",
    "clean_labelled": V.cleaned_sql(extra=", trip_id"),
    "clean_unlabelled": V.cleaned_sql(labelled=False, extra=", trip_id"),
    "csv_intake_clean": V.cleaned_sql(meant_sql(), labelled=False),
    "csv_intake_typed": f"""SELECT count(*) AS trips, count(trip_distance) AS trip_distance_read,
  count(passenger_count) AS passenger_count_read, count(tpep_pickup_datetime) AS tpep_pickup_datetime_read,
  CAST(sum(PULocationID) AS BIGINT) AS PULocationID_sum, CAST(sum(DOLocationID) AS BIGINT) AS DOLocationID_sum
FROM ({meant_sql()}) AS trips""",
    "monthly_union": V.cleaned_sql(_LINE_TRIPS_SQL),
    "monthly_partitions": f"""SELECT "month", count(*) AS trips, CAST(sum(PULocationID) AS BIGINT) AS zones
FROM ({V.cleaned_sql(_LINE_TRIPS_SQL)}) AS cleaned GROUP BY "month" """,
    "cleaned_round_trip": V.cleaned_sql(),
    "hash_split_counts": f"""SELECT CASE WHEN (trip_id * 7919 + 104729) % 100 < 80 THEN 'train' ELSE 'test' END AS side,
  count(*) AS trips, CAST(sum(trip_id) AS BIGINT) AS trip_id_sum
FROM ({V.cleaned_sql(extra=", trip_id")}) AS cleaned GROUP BY 1""",
    "hash_split_whole": f"""SELECT count(*) AS trips, CAST(0 AS BIGINT) AS rows_on_both_sides
FROM ({V.cleaned_sql()}) AS cleaned""",
    "regression_metrics": _quality_sql("round_even({}, 6)", "round_even({}, 6)"),
    "metrics_record_json": _quality_sql(
        "CAST(printf('%.4f', {}) AS DOUBLE)", "CAST(printf('%.2f', {}) AS DOUBLE)"
    ),
}
