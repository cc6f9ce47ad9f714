"""Statistics over the log of scoring runs.

One partially aggregated pass per configuration feeds every figure, so a
configuration with most of the runs costs no more than any other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.functions.naming import base_name
from fareflow.functions.rounding import round_exact, round_scaled


def load_test_runs(log: DataFrame) -> DataFrame:
    return log.filter(F.col("config").startswith(S.LOAD_TEST_PREFIX))


def config_stats(log: DataFrame) -> DataFrame:
    """Unrounded figures per load-test configuration.

    Time stamps are compared as times: text extremes would turn the hash aggregate
    into a sort of the whole log.
    """
    seconds = F.col("duration_seconds")
    logged_at = F.col("timestamp").try_cast("timestamp_ntz")
    return (
        load_test_runs(log)
        .groupBy("config")
        .agg(
            F.avg(seconds).alias("mean"),
            F.stddev_samp(seconds).alias("std"),
            F.min(seconds).alias("min"),
            F.max(seconds).alias("max"),
            F.count(seconds).alias("count"),
            F.avg(F.col("success").cast("double")).alias("success_rate"),
            F.count(F.lit(1)).alias("runs"),
            F.count_if("success").alias("successful"),
            F.count_if(~F.col("success")).alias("failed"),
            F.min(logged_at).alias("first_run"),
            F.max(logged_at).alias("last_run"),
        )
    )


def _throughput() -> Column:
    return F.try_divide(F.lit(3600.0), F.col("mean"))


def runs_by_config(stats: DataFrame, throughput_digits: int = 2) -> DataFrame:
    """One row per configuration, rounded as reported."""
    return stats.select(
        "config",
        *[round_scaled(F.col(c), 2).alias(c) for c in ("mean", "std", "min", "max")],
        "count",
        round_scaled(F.col("success_rate"), 4).alias("success_rate"),
        round_scaled(_throughput(), throughput_digits).alias("throughput_runs_per_hour"),
    )


def _extreme_configs() -> list[Column]:
    """Fastest and slowest mean; equal means resolve to the first label."""
    slowness = F.struct((-F.col("mean")).alias("speed"), F.col("config"))
    timed = F.col("mean").isNotNull()
    return [
        F.min_by("config", F.when(timed, F.struct("mean", "config"))).alias("best_config"),
        F.min_by("config", F.when(timed, slowness)).alias("worst_config"),
    ]


def _total_columns() -> list[Column]:
    return [
        *[
            F.coalesce(F.sum(source), F.lit(0)).alias(name)
            for source, name in (
                ("runs", "total_runs"),
                ("successful", "successful_runs"),
                ("failed", "failed_runs"),
            )
        ],
        F.min("first_run").cast("string").alias("start"),
        F.max("last_run").cast("string").alias("end"),
        *_extreme_configs(),
    ]


def run_totals(stats: DataFrame) -> DataFrame:
    """One row over all load-test runs."""
    return stats.agg(*_total_columns())


# The stored analysis: a record for each configuration, and one without a label for the whole log.
BY_CONFIG = ("config", "mean", "std", "min", "max", "count", "success_rate", "throughput_runs_per_hour")
TOTALS = ("total_runs", "successful_runs", "failed_runs", "start", "end", "best_config", "worst_config")
ANALYSIS = (
    "timestamp string, config string, mean double, std double, min double, max double, count long, success_rate double, "
    "throughput_runs_per_hour double, total_runs long, successful_runs long, failed_runs long, start string, end string, "
    "best_config string, worst_config string"
)


def analysis_rows(stats: DataFrame) -> DataFrame:
    """One row for each configuration and one for all; none grows with the number of labels."""
    now = F.date_format(F.current_timestamp(), S.SECOND_FORMAT).alias("timestamp")
    rows = runs_by_config(stats).unionByName(run_totals(stats), allowMissingColumns=True)
    return rows.select(now, *BY_CONFIG, *TOTALS)


def _by_config(value: Column) -> Column:
    entries = F.array_sort(F.collect_list(F.struct("config", value.alias("value"))))
    return F.map_from_entries(entries)


def analysis_record(stats: DataFrame) -> DataFrame:
    """The whole analysis as one nested row, in the published layout: a map entry per configuration, so for few labels."""
    performance = [
        _by_config(round_scaled(F.col(c), 2)).alias(c) for c in ("mean", "std", "min", "max")
    ]
    figures = stats.agg(
        *_total_columns(),
        *performance,
        _by_config(F.col("count")).alias("count"),
        _by_config(round_scaled(F.col("success_rate"), 4)).alias("success_rate"),
        _by_config(round_scaled(_throughput(), 2)).alias("throughput_runs_per_hour"),
    )
    return figures.select(
        F.date_format(F.current_timestamp(), S.SECOND_FORMAT).alias("timestamp"),
        "total_runs",
        "successful_runs",
        "failed_runs",
        F.struct("start", "end").alias("duration"),
        F.struct("mean", "std", "min", "max", "count").alias("config_performance"),
        "success_rate",
        "throughput_runs_per_hour",
        "best_config",
        "worst_config",
    )


def log_rows(runs: DataFrame) -> DataFrame:
    """Log rows from (timestamp, query_id, path, seconds, success, config)."""
    return runs.select(
        F.date_format("timestamp", S.SECOND_FORMAT).alias("timestamp"),
        "query_id",
        base_name(F.col("path")).alias("input"),
        round_exact(F.col("seconds"), 2).alias("duration_seconds"),
        "success",
        F.coalesce("config", F.lit(S.DEFAULT_CONFIG)).alias("config"),
    )
