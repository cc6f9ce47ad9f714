"""Raw monthly files to the cleaned table: a map-only job over one scan per layout."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from fareflow import schemas as S
from fareflow.sources.tables import write_cleaned
from fareflow.sources.trips import month_paths, read_clean_trips


def preprocess_paths(
    spark: SparkSession, paths: Sequence[str], out: str, by_month: bool = False, format: str | None = None
) -> DataFrame:
    cleaned = read_clean_trips(spark, paths, labelled=True, format=format, year=by_month)
    write_cleaned(cleaned, out, by_month)
    return cleaned.select(*S.CLEANED_COLUMNS)


def preprocess_months(
    spark: SparkSession,
    root: str,
    years: Iterable[int],
    out: str,
    months: Iterable[int] = range(1, 13),
    pattern: str = S.MONTH_FILE_PATTERN,
    by_month: bool = False,
    format: str | None = "parquet",
) -> DataFrame:
    """Cleans every month that exists under `root` into the table at `out`."""
    paths = month_paths(spark, root, years, months, pattern)
    return preprocess_paths(spark, paths, out, by_month, format)
