"""Command line of the jobs: `spark-submit jobs.py <job> …` or `python -m fareflow <job> …`.

Executor counts, memory and cores are spark-submit's own options.
"""

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fareflow import schemas as S
from fareflow.operators.metrics import evaluation_record
from fareflow.operators.model import load_model
from fareflow.operators.results import PREVIEW_COLUMNS, preview, read_result_text, result_catalogue, stored_runs
from fareflow.plans.evaluation import evaluate_cleaned
from fareflow.plans.preprocess import preprocess_months
from fareflow.plans.run_analysis import analyse_runs
from fareflow.plans.scoring import NoValidRows, score_files, score_path_counted
from fareflow.plans.training import train_on_cleaned, train_on_raw
from fareflow.session import build_session
from fareflow.sources import storage
from fareflow.sources.run_log import compact_run_log, read_run_log
from fareflow.sources.tables import export_predictions, read_cleaned, read_submissions
from fareflow.sources.trips import UnreadableTrips, month_paths
from fareflow.streaming.intake import arriving_trips, start_intake


def _years(text: str) -> list[int]:
    first, _, last = text.partition("-")
    return list(range(int(first), int(last or first) + 1))


def preprocess(spark: SparkSession, args: argparse.Namespace) -> None:
    preprocess_months(spark, args.raw, args.years, args.out, pattern=args.pattern, by_month=args.by_month)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    params = {"max_iter": args.rounds, "max_depth": args.depth, "seed": args.seed, "partitions": args.partitions}
    if args.raw or args.files:
        paths = _expanded(spark, args.files) if args.files else month_paths(spark, args.raw, args.years, pattern=args.pattern)
        _, metrics = train_on_raw(spark, paths, args.model, args.cleaned, format=None if args.files else "parquet", **params)
    else:
        _, metrics = train_on_cleaned(read_cleaned(spark, args.cleaned, args.years), args.model, **params)
    _print_row(evaluation_record(metrics))


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    _print_row(evaluate_cleaned(load_model(args.model), read_cleaned(spark, args.cleaned), args.record))


def predict(spark: SparkSession, args: argparse.Namespace) -> None:
    counts = score_path_counted(spark, load_model(args.model), args.input, args.output, args.format)
    print(f"read {counts.input} trips, {counts.valid} of them valid\nscored {counts.valid} trips into {args.output}")


def _expanded(spark: SparkSession, inputs: Sequence[str]) -> list[str]:
    """Each path once, globs as the paths they match; a glob without a match is refused as a missing path."""
    found = [path if storage.exists(spark, path) else storage.expand(spark, path) or path for path in inputs]
    return list(dict.fromkeys(p for paths in found for p in ([paths] if isinstance(paths, str) else paths)))


def submit(spark: SparkSession, args: argparse.Namespace) -> None:
    logged = score_files(spark, load_model(args.model), _expanded(spark, args.input), args.results, args.log, args.config_label, args.format)
    failed = 0
    runs = read_submissions(spark, args.results).select("query_id", "input_rows", "valid_rows", "problem")
    for row in logged.join(runs, "query_id").toLocalIterator():
        failed += not row.success
        print(f"{row.query_id}  {row.input}  {'complete' if row.success else 'failed'}  {row.duration_seconds} s", end="  ")
        print(f"{row.valid_rows} of {row.input_rows} trips scored" if row.success else row.problem)
    if failed:
        sys.exit(1)


def results(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.list:
        stored = stored_runs(spark, args.results)
        submitted = stored
        if args.log:
            submitted = submitted.select("query_id").unionByName(read_run_log(spark, args.log).select("query_id"))
        catalogue = result_catalogue(submitted, stored)
        for row in catalogue.toLocalIterator():
            print(f"{row.query_id:<50} {row.status}")
        return
    stored = f"{args.results}/query_id={args.query}"
    if not storage.exists(spark, stored):
        sys.exit(f"{args.query}: no results")
    print(" ".join(f"{title:>{width}}" for title, width in PREVIEW_COLUMNS.items()))
    for row in preview(read_result_text(spark, stored, args.format), args.rows).collect():
        print(" ".join(row))
    if args.download:
        export_predictions(spark, args.results, args.query, args.download, args.format)


def analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    by_config, totals = analyse_runs(read_run_log(spark, args.log), args.record)
    _print_row(totals)
    rows = by_config.orderBy("config")
    print("  ".join(rows.columns))
    for row in rows.toLocalIterator():
        print("  ".join(str(value) for value in row))


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"merged {compact_run_log(spark, args.log)} folders")


def intake(spark: SparkSession, args: argparse.Namespace) -> None:
    trips = arriving_trips(spark, args.landing, args.schema, args.format, args.files_per_batch)
    query = start_intake(load_model(args.model), trips, args.results, args.checkpoint, once=not args.keep_running)
    query.awaitTermination()


def _print_row(one_row: DataFrame) -> None:
    for name, value in one_row.first().asDict().items():
        print(f"{name}: {value}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fareflow")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, help: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=help)
        sub.set_defaults(run=run)
        return sub

    def months(sub: argparse.ArgumentParser, raw_required: bool) -> None:
        sub.add_argument("--raw", required=raw_required, help="folder of monthly files")
        sub.add_argument("--years", type=_years, help="first-last, or one year")
        sub.add_argument("--pattern", default=S.MONTH_FILE_PATTERN)

    sub = job(preprocess, "clean monthly files into one table")
    months(sub, raw_required=True)
    sub.set_defaults(years=_years("2015-2023"))
    sub.add_argument("--out", required=True)
    sub.add_argument("--by-month", action="store_true", help="lay the table out in year/month folders")

    sub = job(train, "fit and store the model")
    months(sub, raw_required=False)
    sub.add_argument("--files", nargs="+", help="raw files, folders or globs, in place of --raw")
    sub.add_argument("--cleaned", help="cleaned table; with --raw or --files, where to write it")
    sub.add_argument("--model", required=True)
    sub.add_argument("--rounds", type=int, default=50)
    sub.add_argument("--depth", type=int, default=5)
    sub.add_argument("--seed", type=int, default=42)
    sub.add_argument("--partitions", type=int, help="training tasks; by default the cluster's cores, more for a large table")

    sub = job(evaluate, "judge a stored model on the held-out share")
    sub.add_argument("--model", required=True)
    sub.add_argument("--cleaned", required=True)
    sub.add_argument("--record", required=True)

    sub = job(predict, "score one file")
    sub.add_argument("--model", required=True)
    sub.add_argument("--input", required=True)
    sub.add_argument("--output", required=True)
    sub.add_argument("--format", default="csv")

    sub = job(submit, "score files, each under its own id, and log them")
    sub.add_argument("--model", required=True)
    sub.add_argument("--input", required=True, nargs="+", help="files, folders or globs")
    sub.add_argument("--results", required=True)
    sub.add_argument("--log", required=True)
    sub.add_argument("--config-label", default=S.DEFAULT_CONFIG)
    sub.add_argument("--format", default="csv")

    sub = job(results, "list, show or export results")
    sub.add_argument("--results", required=True)
    sub.add_argument("--log", help="with --list, also names runs without a result")
    sub.add_argument("--list", action="store_true")
    sub.add_argument("--query")
    sub.add_argument("--rows", type=int, default=20)
    sub.add_argument("--download")
    sub.add_argument("--format", default="csv")

    sub = job(analyse, "statistics over the run log")
    sub.add_argument("--log", required=True)
    sub.add_argument("--record", required=True)

    sub = job(compact, "merge the run log's small files")
    sub.add_argument("--log", required=True)

    sub = job(intake, "score files as they land")
    sub.add_argument("--model", required=True)
    sub.add_argument("--landing", required=True)
    sub.add_argument("--schema", required=True, help="columns of the landing files, as DDL")
    sub.add_argument("--results", required=True)
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--files-per-batch", type=int)
    sub.add_argument("--keep-running", action="store_true")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    top = parser()
    args = top.parse_args(argv)
    if args.job == "train":
        if not (args.raw or args.files or args.cleaned):
            top.error("train needs --raw, --files or --cleaned")
        if args.raw and not args.years:
            args.years = _years("2022")
    if args.job == "results":
        if not (args.list or args.query):
            top.error("results needs --list or --query")
    try:
        args.run(build_session(f"fareflow {args.job}"), args)
    except (OSError, NoValidRows, UnreadableTrips, ValueError) as error:
        sys.exit(f"Error: {error}")


if __name__ == "__main__":
    main()
