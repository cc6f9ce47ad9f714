"""Analysis of the run log."""

from pyspark.sql import DataFrame, SparkSession

from fareflow.operators.runs import ANALYSIS, BY_CONFIG, TOTALS, analysis_rows, config_stats, run_totals, runs_by_config
from fareflow.session import scratch_path
from fareflow.sources.tables import write_record


def analyse_runs(log: DataFrame, record_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(per configuration, totals); optionally stores both, one JSON record each.

    The log is scanned and aggregated once; all else reads the one row a configuration that this leaves.
    """
    path = scratch_path(log.sparkSession, "config-stats")
    config_stats(log).write.parquet(path)
    stats = log.sparkSession.read.parquet(path)
    if record_path:
        write_record(analysis_rows(stats), record_path)
    return runs_by_config(stats), run_totals(stats)


def read_analysis(spark: SparkSession, record_path: str) -> tuple[DataFrame, DataFrame]:
    """(per configuration, totals) as they were stored."""
    rows = spark.read.schema(ANALYSIS).json(record_path)
    return rows.filter("config IS NOT NULL").select(*BY_CONFIG), rows.filter("config IS NULL").select("timestamp", *TOTALS)
