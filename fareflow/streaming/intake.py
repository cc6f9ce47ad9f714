"""Scoring trip files as they arrive.

A file source feeds the same cleaning and scoring as a batch run. The flow keeps no state: a
restart goes on from the checkpoint. Every micro-batch looks its files' heads up before it
writes a row, and stops the stream uncommitted if one lacks a column; it then
replaces the run folders of its files, so a batch that is run again leaves every row once.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fareflow import schemas as S
from fareflow.functions.naming import run_name
from fareflow.operators.features import clean_trips
from fareflow.operators.model import predict
from fareflow.sources import storage
from fareflow.sources.heads import listed_files
from fareflow.sources.tables import write_predictions_by_run
from fareflow.sources.trips import check_files

# Column that names the landed file of a row.
LANDED = "landed_file"


def _run_of_file() -> Column:
    arrived = F.date_format(F.col("_metadata.file_modification_time"), "yyyyMMdd_HHmmss")
    return run_name(arrived, F.xxhash64(F.col("_metadata.file_path")))


def landed_runs(spark: SparkSession, landing: str) -> DataFrame:
    """(query_id, path) of every file in the folder, from its listing.

    Joined with the stored runs it tells which files were scored, without any state
    in the stream.
    """
    files = spark.read.format("binaryFile").load(landing)
    return files.select(_run_of_file().alias("query_id"), "path")


def arriving_trips(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Unbounded trips, with a `query_id` per file, from a folder of one layout.

    A CSV file with another header, or a Parquet file with another column type or without a
    needed column, stops the stream by its name: one that has landed is refused here, one that lands later by its
    batch, none of whose rows is written. For CSV the schema lists the header's columns in order. The id is made
    of the file's own address and time, so a restarted stream names it alike.
    """
    if format == "parquet" and storage.exists(spark, landing):
        check_files(spark, listed_files(spark, [landing]), labelled=False)
    reader = spark.readStream.schema(schema)
    if format == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    trips = reader.format(format).load(landing)
    return trips.withColumns({"query_id": _run_of_file(), LANDED: F.col("_metadata.file_path")})


def start_intake(
    model: PipelineModel,
    trips: DataFrame,
    root: str,
    checkpoint: str,
    format: str = "parquet",
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Starts scoring `trips` into `root`, a folder per `query_id`.

    `once` drains what has landed and stops; otherwise batches start every `interval`.
    A folder with the log of a file sink is refused: its readers would not see other files.
    """
    spark = trips.sparkSession
    if storage.exists(spark, f"{root}/_spark_metadata"):
        raise ValueError(f"{root} belongs to a file sink")

    def score_batch(batch: DataFrame, _: int) -> None:
        check_files(batch.sparkSession, batch.select(F.col(LANDED).alias("file")).distinct(), labelled=False)
        scored = predict(model, clean_trips(batch, labelled=False, keep=["query_id"]))
        write_predictions_by_run(scored, root, format)

    writer = trips.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
