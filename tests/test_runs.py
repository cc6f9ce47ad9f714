"""Run-log statistics against pandas on small logs."""

import json

import pandas as pd
import pytest

from fareflow import schemas as S
from fareflow.operators.runs import analysis_record, config_stats, run_totals, runs_by_config
from fareflow.plans.run_analysis import analyse_runs, read_analysis

# (config, seconds, success); `single` has one run, `tie` ties with `slow`, `default` is no load test.
RUNS = [
    ("config_slow", 200.0, True), ("config_slow", 100.0, True), ("config_tie", 150.0, False), ("config_tie", 150.0, True),
    ("config_fast", 30.125, True), ("config_fast", 30.135, True), ("config_fast", 31.0, False),
    ("config_single", 99.995, True), ("default", 1.0, False), ("xconfig_a", 1.0, True), ("configXb", 1.0, True),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        (f"2031-05-06 {i:02d}:07:08", f"query_{i}", "a.parquet", seconds, success, config)
        for i, (config, seconds, success) in enumerate(RUNS)
    ]
    return spark.createDataFrame(rows, S.RUN_LOG)


@pytest.fixture(scope="module")
def expected(log):
    frame = pd.DataFrame(RUNS, columns=["config", "seconds", "success"])
    return frame[frame["config"].str.startswith("config_")].groupby("config")


def test_by_config(log, expected):
    stats = expected["seconds"].agg(["mean", "std", "min", "max", "count"]).round(2)
    rate, speed = expected["success"].mean().round(4), (3600 / expected["seconds"].mean()).round(4)
    rows = {r.config: r for r in runs_by_config(config_stats(log), throughput_digits=4).collect()}
    assert set(rows) == set(stats.index)
    for config, row in rows.items():
        for name in ("mean", "min", "max", "count"):
            assert row[name] == stats.loc[config, name]
        assert row.success_rate == rate[config] and row.throughput_runs_per_hour == speed[config]
    assert rows["config_single"].std is None
    assert rows["config_fast"].std == stats.loc["config_fast", "std"]


def test_totals_and_ties(log):
    row = run_totals(config_stats(log)).first()
    assert (row.total_runs, row.successful_runs, row.failed_runs) == (8, 6, 2)
    assert (row.start, row.end) == ("2031-05-06 00:07:08", "2031-05-06 07:07:08")
    assert (row.best_config, row.worst_config) == ("config_fast", "config_slow")


def test_no_load_tests(log):
    row = run_totals(config_stats(log.filter("config = 'default'"))).first()
    assert (row.total_runs, row.successful_runs, row.best_config) == (0, 0, None)


def test_stored_record(spark, log, tmp_path):
    by_config, totals = analyse_runs(log, str(tmp_path / "record"))
    assert by_config.count() == 4 and totals.count() == 1
    lines = [json.loads(line) for part in (tmp_path / "record").glob("part-*.json") for line in part.read_text().splitlines()]
    assert sorted(r["config"] for r in lines if "config" in r) == ["config_fast", "config_single", "config_slow", "config_tie"]
    (whole,) = [r for r in lines if "config" not in r]
    assert whole["total_runs"] == 8 and whole["best_config"] == "config_fast"
    assert list(whole) == ["timestamp", "total_runs", "successful_runs", "failed_runs", "start", "end", "best_config", "worst_config"]
    stored = read_analysis(spark, str(tmp_path / "record"))
    assert sorted(stored[0].collect()) == sorted(by_config.collect())
    assert stored[1].drop("timestamp").collect() == totals.collect()


def test_published_layout(log):
    record = json.loads(analysis_record(config_stats(log)).toJSON().first())
    assert list(record) == [
        "timestamp", "total_runs", "successful_runs", "failed_runs", "duration", "config_performance",
        "success_rate", "throughput_runs_per_hour", "best_config", "worst_config",
    ]
    assert list(record["config_performance"]["mean"]) == ["config_fast", "config_single", "config_slow", "config_tie"]
    assert record["config_performance"]["count"]["config_fast"] == 3
    assert record["throughput_runs_per_hour"]["config_slow"] == 24.0


def test_very_many_labels(spark, tmp_path):
    rows = spark.range(300_000).selectExpr(
        "'2026-05-01 10:00:00' AS timestamp", "concat('query_', id) AS query_id", "'a.csv' AS input",
        "id % 100000 + 1.0D AS duration_seconds", "id % 5 <> 0 AS success", "concat('config_', id % 100000) AS config",
    )
    by_config, totals = analyse_runs(rows, str(tmp_path / "record"))
    assert by_config.count() == 100_000
    row = read_analysis(spark, str(tmp_path / "record"))[1].first()
    assert (row.total_runs, row.best_config, row.worst_config) == (300_000, "config_0", "config_99999")
    longest = max(len(line) for part in (tmp_path / "record").glob("part-*.json") for line in part.read_text().splitlines())
    assert longest < 400


def test_the_log_is_scanned_once(spark, log, tmp_path):
    """What is returned, and what is stored, reads the aggregate that one pass over the log left."""
    log.write.parquet(str(tmp_path / "log"))
    frames = analyse_runs(spark.read.parquet(str(tmp_path / "log")))
    for frame in frames:
        assert all("config-stats" in file for file in frame.inputFiles())


def test_log_is_hash_aggregated_in_one_pass(log):
    plan = config_stats(log)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "SortAggregate" not in plan
    assert plan.count("hashpartitioning(config") == 1
