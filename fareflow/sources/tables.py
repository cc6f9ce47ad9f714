"""Readers and writers of the tables the jobs exchange."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import schemas as S
from fareflow.sources import storage


def write_cleaned(df: DataFrame, path: str, by_month: bool = False) -> None:
    """Overwrites the cleaned table.

    The plain layout is written by the scan's own tasks. `by_month` adds year/month
    folders for pruning; the rebalance gathers each month into few files and lets
    adaptive execution split a month that holds most rows.
    """
    if by_month:
        df.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_cleaned(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """Cleaned trips; `years` prunes folders and needs the by-month layout."""
    if years is not None and not storage.expand(spark, f"{path}/year=*"):
        raise ValueError(f"{path} has no year folders")
    schema = S.CLEANED if years is None else T.StructType([*S.CLEANED.fields, T.StructField("year", T.IntegerType())])
    df = spark.read.schema(schema).parquet(path)
    if years is not None:
        df = df.filter(F.col("year").isin(list(years)))
    return df.select(*S.CLEANED_COLUMNS)


def csv_reader(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    """Our own CSV: the header must match the schema, or the scan refuses the file."""
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")


def write_predictions(df: DataFrame, path: str, format: str = "csv") -> None:
    """One table per run: as many part files as scoring tasks, written where they were scored."""
    df.select(*S.PREDICTION_COLUMNS).write.mode("overwrite").format(format).option("header", "true").save(path)


def write_predictions_by_run(df: DataFrame, root: str, format: str = "csv") -> None:
    """Adds many runs in one job, a folder per `query_id`.

    Dynamic overwrite touches only the folders written, and stages them apart from
    those of other jobs, so submissions may run side by side on one `root`.
    """
    (
        df.select(*S.PREDICTION_COLUMNS, "query_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("query_id")
        .format(format)
        .option("header", "true")
        .save(root)
    )


def read_predictions(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Predictions of one run."""
    if format == "csv":
        return csv_reader(spark, S.PREDICTIONS).csv(path)
    return spark.read.schema(S.PREDICTIONS).format(format).load(path)


def read_predictions_by_run(spark: SparkSession, root: str, format: str = "csv") -> DataFrame:
    """Predictions of all runs under `root`, with their `query_id`."""
    schema = T.StructType([*S.PREDICTIONS.fields, T.StructField("query_id", T.StringType())])
    reader = spark.read.schema(schema).option("header", "true")
    return reader.format(format).load(root)


def write_record(record: DataFrame, path: str) -> None:
    record.write.mode("overwrite").json(path)


def append_submission(manifest: DataFrame, root: str) -> None:
    """Adds rows to the manifest of a result folder, which its readers pass over."""
    manifest.select(*S.SUBMISSIONS.fieldNames()).coalesce(1).write.mode("append").parquet(f"{root}/{S.MANIFEST}/part-{uuid.uuid4().hex}")


def read_submissions(spark: SparkSession, root: str) -> DataFrame:
    """Of every run ever submitted to `root`: its input, its counts of trips, and what was wrong with it."""
    if not storage.exists(spark, f"{root}/{S.MANIFEST}"):
        return spark.createDataFrame([], S.SUBMISSIONS)
    return spark.read.schema(S.SUBMISSIONS).option("recursiveFileLookup", "true").parquet(f"{root}/{S.MANIFEST}")


def export_predictions(
    spark: SparkSession,
    root: str,
    query_id: str,
    target: str,
    format: str = "csv",
    single_file: bool = True,
) -> None:
    """Writes `<target>/<query_id>_results.csv`.

    Without `single_file` it is a folder of parts of that name, so that no single task
    has to write it all; the size of the result has no say. An earlier export is replaced once
    the new one is written; if that fails, it is still there. A folder is not replaced by a file.
    """
    stored, out = f"{root}/query_id={query_id}", f"{target}/{query_id}_results.csv"
    result = read_predictions(spark, stored, format)
    written = f"{out}.part-{uuid.uuid4().hex}"
    write_predictions(result if not single_file else result.coalesce(1), written)
    if single_file:
        storage.promote_part(spark, written, out)
    else:
        storage.replace(spark, written, out)
