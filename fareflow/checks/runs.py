"""Queries over the run log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.checks import views as V
from fareflow.functions.naming import RunNames, shared_names
from fareflow.operators.runs import config_stats, load_test_runs, log_rows, run_totals, runs_by_config
from fareflow.plans.run_analysis import analyse_runs, read_analysis
from fareflow.session import scratch_path
from fareflow.sources.run_log import append_run_log, compact_run_log, read_run_log


def runlog_load_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_test_runs(V.run_log(spark, sf_dir))


def _analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_by_config(config_stats(V.run_log(spark, sf_dir)), throughput_digits=4)


def runlog_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).select("config", "mean", "std", "min", "max", "count")


def runlog_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).select("config", "success_rate", "throughput_runs_per_hour")


def runlog_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(config_stats(V.run_log(spark, sf_dir))).drop("best_config", "worst_config")


def runlog_best_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(config_stats(V.run_log(spark, sf_dir))).select("best_config", "worst_config")


def runlog_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All configurations equally fast: both extremes are the first label."""
    level = V.run_log(spark, sf_dir).withColumn("duration_seconds", F.lit(60.0))
    return run_totals(config_stats(level)).select("best_config", "worst_config")


def _submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events")
    return events.select(
        F.col("ts").alias("timestamp"),
        F.expr(V.RUN_ID).alias("query_id"),
        F.concat(F.lit("/landing/"), "event_type", F.lit("/"), F.expr(V.RUN_LOG["input"])).alias("path"),
        (F.col("value") / 7).alias("seconds"),
        F.expr(V.RUN_LOG["success"]).alias("success"),
        F.expr("CASE WHEN event_type <> 'error' THEN concat('config_', event_type) END").alias("config"),
    )


def runlog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, then one read of the stored log."""
    path = scratch_path(spark, "run-log")
    submitted = _submitted(spark, sf_dir)
    for succeeded in (submitted.filter("success"), submitted.filter("NOT success")):
        append_run_log(log_rows(succeeded), path)
    return read_run_log(spark, path)


_FIGURES = ("mean", "std", "min", "max", "count")
_RATES = ("success_rate", "throughput_runs_per_hour")


def runlog_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored analysis, read back and laid out as one row per configuration and figure."""
    root = scratch_path(spark, "analysis")
    append_run_log(V.run_log(spark, sf_dir), f"{root}/log")
    analyse_runs(read_run_log(spark, f"{root}/log"), f"{root}/record")
    by_config, totals = read_analysis(spark, f"{root}/record")
    figures = F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for c in (*_FIGURES, *_RATES)])
    long = by_config.select("config", F.explode(figures).alias("f")).select("config", "f.*").filter("value IS NOT NULL")
    return long.crossJoin(F.broadcast(totals.select("best_config", "worst_config")))


def run_names_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name for each line item's key, as for so many inputs: how many there are, and how many are shared."""
    uri = F.concat(F.lit("file:/in/"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit(".csv")).alias("uri")
    named = RunNames().named(V.table(spark, sf_dir, "lineitem").select(uri).distinct())
    shared = F.lit(shared_names(named).count()).alias("shared")
    spelled = F.count_if(F.col("query_id").rlike("^query_[0-9]{8}_[0-9]{6}_[0-9a-f]{16}$")).alias("spelled")
    return named.agg(F.count("*").alias("inputs"), spelled).select("inputs", "spelled", shared)


def runlog_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after appends, a merge, more appends and another merge."""
    path = scratch_path(spark, "run-log")
    submitted = _submitted(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(6)))
    for part in range(6):
        append_run_log(log_rows(submitted.filter(F.col("part") == part)), path)
        if part in (2, 4):
            compact_run_log(spark, path)
    return read_run_log(spark, path)


QUERIES = {
    "runlog_load_tests": runlog_load_tests,
    "runlog_by_config": runlog_by_config,
    "runlog_rates": runlog_rates,
    "runlog_totals": runlog_totals,
    "runlog_best_worst": runlog_best_worst,
    "runlog_ties": runlog_ties,
    "runlog_append": runlog_append,
    "runlog_analysis": runlog_analysis,
    "run_names_unique": run_names_unique,
    "runlog_compacted": runlog_compacted,
}

_LOG_SQL = V.as_sql("events", V.RUN_LOG)
_LOAD_TESTS_SQL = f"SELECT * FROM ({_LOG_SQL}) AS log WHERE starts_with(config, 'config_')"
_MEANS_SQL = f"SELECT config, avg(duration_seconds) AS m FROM ({_LOAD_TESTS_SQL}) AS runs GROUP BY config"
_BEST_COLUMNS_SQL = f"""(SELECT config FROM ({_MEANS_SQL}) AS a ORDER BY m, config LIMIT 1) AS best_config,
  (SELECT config FROM ({_MEANS_SQL}) AS b ORDER BY m DESC, config LIMIT 1) AS worst_config"""


def _rounded_sql(value: str, digits: int) -> str:
    return f"round_even({value} * {10**digits}, 0) / {10**digits}"


_FIGURES_SQL = {
    "mean": _rounded_sql("avg(duration_seconds)", 2),
    "std": _rounded_sql("stddev_samp(duration_seconds)", 2),
    "min": _rounded_sql("min(duration_seconds)", 2),
    "max": _rounded_sql("max(duration_seconds)", 2),
    "count": "count(duration_seconds)",
    "success_rate": _rounded_sql("avg(CAST(success AS DOUBLE))", 4),
    "throughput_runs_per_hour": _rounded_sql("3600 / avg(duration_seconds)", 2),
}


def _grouped_sql(columns: dict[str, str]) -> str:
    listed = ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())
    return f"SELECT config, {listed} FROM ({_LOAD_TESTS_SQL}) AS runs GROUP BY config"


_APPENDED_SQL = f"""SELECT "timestamp", query_id, input,
  CAST(printf('%.2f', duration_seconds / 7) AS DOUBLE) AS duration_seconds, success, config FROM ({_LOG_SQL}) AS log"""


ORACLES = {
    "runlog_load_tests": _LOAD_TESTS_SQL,
    "runlog_by_config": _grouped_sql({c: _FIGURES_SQL[c] for c in _FIGURES}),
    "runlog_rates": _grouped_sql(
        {
            "success_rate": _FIGURES_SQL["success_rate"],
            "throughput_runs_per_hour": _rounded_sql("3600 / avg(duration_seconds)", 4),
        }
    ),
    "runlog_totals": f"""SELECT count(*) AS total_runs, count(*) FILTER (success) AS successful_runs,
  count(*) FILTER (NOT success) AS failed_runs, min("timestamp") AS "start", max("timestamp") AS "end"
FROM ({_LOAD_TESTS_SQL}) AS runs""",
    "runlog_best_worst": f"SELECT {_BEST_COLUMNS_SQL}",
    "runlog_ties": f"SELECT min(config) AS best_config, min(config) AS worst_config FROM ({_LOAD_TESTS_SQL}) AS runs",
    "runlog_append": _APPENDED_SQL,
    "runlog_compacted": _APPENDED_SQL,
    "run_names_unique": """SELECT count(*) AS inputs, count(*) AS spelled, CAST(0 AS BIGINT) AS shared
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS inputs""",
    "runlog_analysis": "\nUNION ALL\n".join(
        f"""SELECT {_BEST_COLUMNS_SQL}, '{name}' AS figure, config, CAST(v AS DOUBLE) AS "value"
FROM ({_grouped_sql({"v": sql})}) AS grouped"""
        for name, sql in _FIGURES_SQL.items()
    ),
}
