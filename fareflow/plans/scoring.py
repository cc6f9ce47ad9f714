"""Scoring submitted trip files.

Many files are one job: a scan per layout, row-by-row scoring, and a write into a
folder per run. Nothing is shuffled and nothing is gathered into one task, so a
single huge file is scored by as many tasks as it has splits. The rows of each run are
counted on the way.
"""

import re
import time
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.functions.naming import RunNames, shared_names
from fareflow.operators.features import clean_trips
from fareflow.operators.model import predict
from fareflow.operators.runs import log_rows
from fareflow.sources import storage
from fareflow.sources.run_log import append_run_log
from fareflow.sources.tables import append_submission, read_submissions, write_predictions, write_predictions_by_run
from fareflow.sources.trips import INPUT_URI, Layout, check_inputs, look_up, scan

# Fixed value: the error condition of a file that cannot be read to its end.
READ_FAILURE = "FAILED_READ_FILE"

# Inputs that one job scores; the driver holds the addresses and counts of so many at a time.
INPUTS_PER_JOB = 10_000


class NoValidRows(ValueError):
    """Cleaning left nothing to score."""


@dataclass(frozen=True)
class Counts:
    """Trips that an input holds, and those of them that were valid and so scored."""

    input: int
    valid: int


def score(model: PipelineModel, trips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw trips in any layout to predictions; `keep` passes row keys through."""
    cleaned = clean_trips(trips, labelled=False, keep=keep)
    return predict(model, cleaned).select(*S.PREDICTION_COLUMNS, *keep)


def score_path_counted(spark: SparkSession, model: PipelineModel, path: str, out: str, format: str = "csv") -> Counts:
    """Scores one file into the folder `out` in one pass; the input is left alone.

    Without a valid row `out` stays as it was, and NoValidRows is raised.
    """
    check_inputs(spark, [path])
    ((layout, rows),) = look_up(spark, [path], labelled=False).values()
    if not isinstance(layout, Layout):
        raise layout
    read, valid = Observation(), Observation()
    trips = scan(spark, layout, [path])
    if rows is None:
        trips = trips.observe(read, F.count(F.lit(1)).alias("n"))
    written = f"{out.rstrip('/')}.part-{uuid.uuid4().hex}"
    write_predictions(score(model, trips).observe(valid, F.count(F.lit(1)).alias("n")), written, format)
    counts = Counts(read.get["n"] if rows is None else rows, valid.get["n"])
    if not counts.valid:
        storage.delete(spark, written)
        raise NoValidRows(path)
    storage.replace(spark, written, out)
    return counts


def score_path(spark: SparkSession, model: PipelineModel, path: str, out: str, format: str = "csv") -> int:
    """As above; returns how many trips it scored."""
    return score_path_counted(spark, model, path, out, format).valid


def _rows_by(key: Column, inputs: int) -> Column:
    """Rows of each of so many keys, exactly: the sketch has room for all of them."""
    return F.call_function("approx_top_k", key, F.lit(inputs), F.lit(4 * inputs)).alias("rows")


def _observed(observation: Observation) -> dict[int, int]:
    return {row["item"]: row["count"] for row in observation.get["rows"]}


def _write_many(
    spark: SparkSession, model: PipelineModel, inputs: dict[str, tuple[Layout, int | None]], names: RunNames, root: str, format: str
) -> tuple[dict[int, int], dict[int, int]]:
    """Scores all inputs in one job; by digest of the input, the rows read where they were not known, and those scored."""
    groups: dict[Layout, list[str]] = defaultdict(list)
    uncounted: dict[Layout, bool] = defaultdict(bool)
    for path, (layout, rows) in inputs.items():
        groups[layout].append(path)
        uncounted[layout] |= rows is None
    frames, read = [], []
    for layout, paths in groups.items():
        trips = scan(spark, layout, paths, name_input=True)
        if uncounted[layout]:
            read.append(Observation())
            trips = trips.observe(read[-1], _rows_by(names.digest(F.col(INPUT_URI)), len(paths)))
        frames.append(clean_trips(trips, labelled=False, keep=[INPUT_URI]))
    scored, valid = predict(model, reduce(DataFrame.unionByName, frames)), Observation()
    scored = scored.observe(valid, _rows_by(names.digest(F.col(INPUT_URI)), len(inputs)))
    write_predictions_by_run(scored.withColumn("query_id", names.column(F.col(INPUT_URI))), root, format)
    return {key: n for seen in read for key, n in _observed(seen).items()}, _observed(valid)


def _unreadable_file(error: Exception) -> str | None:
    """The address that Spark names as the file it could not read to its end."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        found = re.match(rf"\[{READ_FAILURE}.*?while reading file (\S+?)\.?\s", f"{cause.getMessage()} ")
        if found:
            return re.sub(r"^file:/+", "file:/", found[1])
        cause = cause.getCause()
    return None


def _owner(file: str, uris: dict[str, str]) -> str | None:
    """The submitted path at or below which the file lies."""
    while file and file not in uris:
        file = file.rpartition("/")[0]
    return uris.get(file)


def _score_readable(
    spark: SparkSession, model: PipelineModel, uris: dict[str, str], names: RunNames, root: str, format: str
) -> dict[str, tuple[int | None, int, str | None]]:
    """By path: rows read, rows scored, and what was wrong with it.

    If a file proves damaged in the scan, its input is taken out and the others are run again: one more job
    for each damaged input. Raises if all are, or for another reason than reading.
    """
    found = look_up(spark, list(uris.values()), labelled=False)
    good = {path: (layout, rows) for path, (layout, rows) in found.items() if isinstance(layout, Layout)}
    problems = {path: str(layout) for path, (layout, _) in found.items() if not isinstance(layout, Layout)}
    read, valid = {}, {}
    while good:
        try:
            read, valid = _write_many(spark, model, good, names, root, format)
            break
        except (PySparkException, Py4JJavaError) as error:
            file = _unreadable_file(error)
            path = _owner(file, uris) if file else None
            if path not in good or len(good) == 1:
                raise
            del good[path]
            problems[path] = f"cannot read {file}"
    digests = spark.createDataFrame([(uri,) for uri in uris], "uri string").select("uri", names.digest(F.col("uri")).alias("digest"))
    outcome = {}
    for row in digests.toLocalIterator():
        path = uris[row.uri]
        known = found[path][1] if path in good else None
        rows = known if known is not None else read.get(row.digest, 0) if path in good else None
        scored = valid.get(row.digest, 0)
        outcome[path] = rows, scored, problems.get(path) or (None if scored else "no valid row")
    return outcome


_OUTCOMES = (
    "finished timestamp, uri string, path string, seconds double, config string, "
    "input_rows long, valid_rows long, scored_rows long, success boolean, problem string"
)


def score_files(
    spark: SparkSession,
    model: PipelineModel,
    paths: Sequence[str],
    root: str,
    log_path: str,
    config: str = S.DEFAULT_CONFIG,
    format: str = "csv",
    inputs_per_job: int = INPUTS_PER_JOB,
) -> DataFrame:
    """Scores every path under its own run id and logs one row per path.

    A missing path or unknown suffix is refused before anything runs. A path that
    cannot be read, lacks a column or has no valid row is logged as failed and
    does not hold up the others; if damage shows in the scan of every path, the error is
    raised once it is logged. A logged duration is the run's even share of its
    job's time, so that rates over the log are those of the work done. The manifest beside the
    results says of each run what was read, valid and scored, and what was wrong. Returns the logged rows.
    """
    check_inputs(spark, paths)
    uris = {storage.uri(spark, p): p for p in paths}
    if len(uris) < len(paths):
        raise ValueError("the same input is given twice")
    names, submission = RunNames(), uuid.uuid4().hex
    if not shared_names(names.named(spark.createDataFrame([(u,) for u in uris], "uri string"))).isEmpty():
        raise RuntimeError("two inputs have the same name; submit again")

    def log(part: dict[str, str], outcome: dict[str, tuple], clock: float) -> DataFrame:
        seconds, finished = (time.monotonic() - clock) / max(1, len(part)), datetime.now(UTC)
        rows = []
        for uri, path in part.items():
            read, scored, problem = outcome.get(path, (None, 0, "the job failed"))
            rows.append((finished, uri, path, seconds, config, read, scored, scored, scored > 0, problem))
        table = names.named(spark.createDataFrame(rows, _OUTCOMES)).withColumn("submission", F.lit(submission))
        append_run_log(log_rows(table.withColumnRenamed("finished", "timestamp")), log_path)
        return table

    everything = list(uris.items())
    for low in range(0, len(everything), inputs_per_job):
        part, clock = dict(everything[low : low + inputs_per_job]), time.monotonic()
        try:
            outcome = _score_readable(spark, model, part, names, root, format)
        except Exception:
            log(dict(everything[low:]), {}, clock)
            raise
        append_submission(log(part, outcome, clock), root)
    mine = read_submissions(spark, root).filter(F.col("submission") == submission)
    return log_rows(mine.withColumnRenamed("finished", "timestamp"))
