"""Looking at stored results: which runs have one, and how its first rows read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import schemas as S
from fareflow.functions.rounding import fixed_text, right_align
from fareflow.sources import storage

# Column titles and widths of the printed preview.
PREVIEW_COLUMNS = {
    "distance": 10,
    "pickup zone": 12,
    "dropoff zone": 13,
    "passengers": 11,
    "predicted fare": 15,
}


def stored_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs under `root` that have part files, with count and size, from the listing alone.

    No prediction is read, so the cost follows the number of files and not of rows.
    """
    if not storage.exists(spark, root):
        return spark.createDataFrame([], "query_id string, files bigint, bytes bigint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(root)
    if "query_id" not in files.columns:
        files = files.withColumn("query_id", F.lit(None).cast("string"))
    return (
        files.filter(F.col("query_id").isNotNull())
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def result_catalogue(submitted: DataFrame, stored: DataFrame) -> DataFrame:
    """Every submitted run with `complete` or `no results`, by name.

    Both sides are one row per run when joined, so no key is hot.
    """
    ids = submitted.select("query_id").distinct()
    status = F.when(F.col("stored"), "complete").otherwise("no results")
    return (
        ids.join(stored.select("query_id", F.lit(True).alias("stored")), "query_id", "left")
        .select("query_id", status.alias("status"))
        .orderBy("query_id")
    )


def rows_per_run(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("query_id").agg(F.count(F.lit(1)).alias("rows"))


def read_result_text(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """A stored result with every field as text."""
    if format != "csv":
        stored = spark.read.schema(S.PREDICTIONS).format(format).load(path)
        return stored.select([F.col(c).cast("string") for c in S.PREDICTION_COLUMNS])
    text = T.StructType([T.StructField(c, T.StringType()) for c in S.PREDICTION_COLUMNS])
    return spark.read.schema(text).option("header", "true").option("enforceSchema", "false").csv(path)


def readable_rows(result_text: DataFrame) -> DataFrame:
    """Rows with all five fields whose distance and prediction are numbers."""
    numbers = {c: F.col(c).try_cast("double") for c in ("trip_distance", S.PREDICTION)}
    return result_text.dropna().withColumns(numbers).dropna(subset=list(numbers))


def preview(result_text: DataFrame, rows: int = 20, order_by: list | None = None) -> DataFrame:
    """First rows as padded text. Unordered it stops at the first partition with enough rows."""
    readable = readable_rows(result_text)
    if order_by:
        readable = readable.orderBy(*order_by)
    distance, pickup, dropoff, passengers, fare = PREVIEW_COLUMNS.values()
    return readable.limit(rows).select(
        right_align(fixed_text(F.col("trip_distance"), 1), distance).alias("distance"),
        right_align(F.col("PULocationID"), pickup).alias("pickup_zone"),
        right_align(F.col("DOLocationID"), dropoff).alias("dropoff_zone"),
        right_align(F.col("passenger_count"), passengers).alias("passengers"),
        F.concat(F.lit("$"), right_align(fixed_text(F.col(S.PREDICTION), 2), fare - 1)).alias("predicted_fare"),
    )
