"""Catalogue and preview of stored results."""

import pytest

from fareflow import schemas as S
from fareflow.operators.results import preview, read_result_text, result_catalogue, rows_per_run, stored_runs
from fareflow.sources.tables import read_predictions_by_run, write_predictions_by_run

ROWS = [(3.7, 41, 66, 1.0, 14.625001953125), (0.35, 12, 88, 2.0, 7.334999990000001), (1234567.25, 1, 2, 6.0, 8.005)]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_catalogue(spark, tmp_path, format):
    root = str(tmp_path / "out")
    scored = spark.createDataFrame([(*r, f"query_{i % 2}") for i, r in enumerate(ROWS)], [*S.PREDICTION_COLUMNS, "query_id"])
    submitted = spark.createDataFrame([("query_9",), ("query_1",), ("query_0",), ("query_1",)], "query_id string")
    assert [tuple(r) for r in result_catalogue(submitted, stored_runs(spark, root)).collect()] == [
        (q, "no results") for q in ("query_0", "query_1", "query_9")
    ]
    write_predictions_by_run(scored, root, format)
    assert [tuple(r) for r in result_catalogue(submitted, stored_runs(spark, root)).collect()] == [
        ("query_0", "complete"), ("query_1", "complete"), ("query_9", "no results")
    ]
    counts = rows_per_run(read_predictions_by_run(spark, root, format)).collect()
    assert {r.query_id: r.rows for r in counts} == {"query_0": 2, "query_1": 1}


def test_listing_reads_no_prediction(spark, tmp_path):
    scored = spark.createDataFrame([(*ROWS[0], "query_0")], [*S.PREDICTION_COLUMNS, "query_id"])
    write_predictions_by_run(scored, str(tmp_path))
    plan = stored_runs(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1]


def _stored(tmp_path, *lines):
    (tmp_path / "part-0.csv").write_text("\n".join([",".join(S.PREDICTION_COLUMNS), *lines]) + "\n")
    return str(tmp_path)


def test_preview_prints_as_published(spark, tmp_path):
    path = _stored(tmp_path, *[",".join(map(str, r)) for r in ROWS])
    lines = [" ".join(r) for r in preview(read_result_text(spark, path)).collect()]
    assert lines == [f"{d:>10.1f} {p:>12} {o:>13} {n:>11} ${f:>14.2f}" for d, p, o, n, f in ROWS]


def test_preview_skips_rows_that_cannot_be_shown(spark, tmp_path):
    path = _stored(tmp_path, "abc,1,2,1.0,3.0", "1.0,1,2,1.0,xyz", "1.0,1,2", "1.0,1,2,1.0,3.0", "2.0,1,2,1.0,4.0")
    text = read_result_text(spark, path)
    assert preview(text).count() == 2
    assert [r.distance.strip() for r in preview(text, rows=1, order_by=["prediction"]).collect()] == ["1.0"]
