"""Names of scoring runs and of their inputs."""

import secrets
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def run_name(stamp: Column, digest: Column) -> Column:
    """`query_<yyyymmdd_HHMMSS>_<16 hex>`, the hex part a 64-bit digest."""
    return F.concat(F.lit("query_"), stamp, F.lit("_"), F.lpad(F.lower(F.hex(digest)), 16, "0"))


class RunNames:
    """Run names for the inputs of one submission.

    The digest covers the input's address and a random salt, so an executor derives
    the name for the file it is reading without a lookup table, and the driver keeps none. It is
    evaluated for every row of a file, hence a cheap one. Among a million inputs two share one
    with a chance of one in 37 million.
    """

    def __init__(self) -> None:
        self._stamp = datetime.now(UTC).strftime("%Y%m%d_%H%M%S")
        self._salt = secrets.randbits(62)

    def digest(self, uri: Column) -> Column:
        return F.xxhash64(F.lit(self._salt), uri)

    def column(self, uri: Column) -> Column:
        return run_name(F.lit(self._stamp), self.digest(uri))

    def named(self, inputs: DataFrame) -> DataFrame:
        """Rows with a `uri` and their `query_id`."""
        return inputs.withColumn("query_id", self.column(F.col("uri")))


def shared_names(named: DataFrame) -> DataFrame:
    """(query_id, inputs) of the names that more than one row has; counted where the rows are."""
    return named.groupBy("query_id").agg(F.count("*").alias("inputs")).filter("inputs > 1")
