"""Queries that fit, store, reload and apply the fare model.

Fitted trees have no SQL form: the queries state what must hold whatever was fitted, and hold
stored predictions, by value, against those of `score`.
"""

import math
from functools import cache

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.checks import views as V
from fareflow.checks.trips import clean_labelled, cleaned_round_trip, portable_bucket
from fareflow.operators.features import clean_trips
from fareflow.operators.metrics import TOLERANCES, evaluation_record, regression_metrics
from fareflow.operators.model import fit_fares, load_model, predict, save_model
from fareflow.operators.results import result_catalogue, stored_runs
from fareflow.operators.split import hash_split
from fareflow.plans.evaluation import evaluate_cleaned
from fareflow.plans.scoring import score, score_files, score_path
from fareflow.plans.training import train_on_cleaned
from fareflow.session import scratch_path
from fareflow.sources import storage
from fareflow.sources.tables import read_predictions, read_predictions_by_run, read_submissions
from fareflow.streaming.intake import arriving_trips, landed_runs, start_intake


@cache
def _saved_model(application: str, spark: SparkSession, sf_dir: str) -> str:
    """Path of a model fitted once per application and table folder."""
    path = scratch_path(spark, "model")
    train_on_cleaned(cleaned_round_trip(spark, sf_dir), path)
    return path


def saved_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return load_model(_saved_model(spark.sparkContext.applicationId, spark, sf_dir))


def _judged(metrics: DataFrame, cleaned: DataFrame) -> list:
    """What must hold of the quality on the held-out share of `cleaned`, whatever was fitted."""
    rows = cleaned.count()
    within = [F.col(f"percentage_within_{t}_dollar") for t in TOLERANCES]
    return [
        F.lit(rows).alias("trips"),
        F.col("test_records").between(0.16 * rows, 0.24 * rows).alias("a_fifth_held_out"),
        ((F.col("r2") > 0.8) & (F.col("r2") <= 1)).alias("learned"),
        ((F.col("mae") > 0) & (F.col("mae") <= F.col("rmse"))).alias("errors_ordered"),
        ((within[0] <= within[1]) & (within[1] <= within[2]) & (within[2] <= 100)).alias("shares_ordered"),
    ]


def gbt_train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaned_round_trip(spark, sf_dir)
    _, metrics = train_on_cleaned(cleaned)
    return metrics.select(*_judged(metrics, cleaned))


def gbt_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved model judged on the held-out share; the record is stored, read back, and equals the rounded metrics."""
    record_path = scratch_path(spark, "evaluation")
    model, cleaned = saved_model(spark, sf_dir), cleaned_round_trip(spark, sf_dir)
    record = evaluate_cleaned(model, cleaned, record_path)
    rounded = evaluation_record(regression_metrics(predict(model, hash_split(cleaned)[1]))).first()
    figures = [c for c in record.columns if c != "timestamp"]
    same = F.lit(True)
    for c in figures:
        same = same & F.col(c).eqNullSafe(F.lit(rounded[c]))
    return record.select(*_judged(record, cleaned), same.alias("as_computed"))


def gbt_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a stored model beside the trips' keys; `prediction` tells that it is a number within the fares learnt."""
    scored = score(saved_model(spark, sf_dir), V.event_trips(spark, sf_dir), keep=["trip_id"])
    return scored.withColumn(S.PREDICTION, F.col(S.PREDICTION).between(-50, 200))


def hash_split_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default split of the distinct line items: both shares whole, and a fifth held out."""
    cleaned = clean_trips(V.line_trips(spark, sf_dir), labelled=True).distinct()
    train, test = hash_split(cleaned)
    sides = train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))
    share = F.count_if("held_out") / F.count("*")
    return sides.agg(F.count("*").alias("trips"), share.between(0.18, 0.22).alias("fair"))


def gbt_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out quality of fitted trees: learned, better than the mean fare, and as MLlib's evaluator has it."""
    trips = clean_trips(V.event_trips(spark, sf_dir), labelled=True, keep=["trip_id"])
    train, test = hash_split(trips, bucket=portable_bucket())
    scored = predict(fit_fares(train), test)
    metrics = regression_metrics(scored)
    agreement = []
    for name in ("rmse", "r2", "mae"):
        expected = RegressionEvaluator(labelCol=S.LABEL, predictionCol=S.PREDICTION, metricName=name).evaluate(scored)
        agreement.append((F.abs(F.col(name) - expected) <= 1e-9 * (1 + abs(expected))).alias(f"{name}_agrees"))
    within = [F.col(f"percentage_within_{t}_dollar") for t in TOLERANCES]
    return metrics.select(
        "test_records",
        (F.col("r2") > 0.8).alias("learned"),
        *agreement,
        ((within[0] <= within[1]) & (within[1] <= within[2])).alias("shares_ordered"),
    )


def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on which a model and its stored copy agree: all of them."""
    cleaned = clean_labelled(spark, sf_dir)
    fitted = fit_fares(cleaned)
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    once = predict(fitted, cleaned).withColumnRenamed(S.PREDICTION, "fitted")
    both = predict(load_model(path), once)
    return both.agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(F.col(S.PREDICTION) == F.col("fitted")).alias("equal")
    )


def gbt_same_model_any_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models fitted by 8 and by 64 tasks, of 20 rounds: the same bins, and no trip on which they differ."""
    cleaned = clean_labelled(spark, sf_dir)
    few, many = (fit_fares(cleaned.repartition(n // 4), partitions=n, max_iter=20) for n in (8, 64))
    both = predict(many, predict(few, cleaned).withColumnRenamed(S.PREDICTION, "few"))
    return both.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.abs(F.col(S.PREDICTION) - F.col("few")) > 1e-9).alias("differing"),
        F.lit(few.stages[0].getSplitsArray() == many.stages[0].getSplitsArray()).alias("same_bins"),
    )


def _as_expected(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """The stored rows; `prediction` tells whether so many alike were expected."""
    columns = list(S.PREDICTION_COLUMNS)
    there = stored.groupBy(*columns).agg(F.count("*").alias("there"))
    wanted = expected.groupBy(*columns).agg(F.count("*").alias("wanted"))
    rows = there.join(wanted, columns, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), "there")))
    return rows.withColumn(S.PREDICTION, F.coalesce(F.col("there") == F.col("wanted"), F.lit(False))).select(columns)


def score_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, trips = scratch_path(spark, "one-file"), V.event_trips(spark, sf_dir)
    trips.write.option("header", "true").csv(f"{root}/trips.csv")
    model = saved_model(spark, sf_dir)
    score_path(spark, model, f"{root}/trips.csv", f"{root}/out")
    return _as_expected(read_predictions(spark, f"{root}/out"), score(model, trips))


def _score_all(spark: SparkSession, sf_dir: str, paths: list[str], root: str, trips: DataFrame) -> DataFrame:
    """One job over all paths; per path its logged outcome, its rows, and those that `trips` (with their `input`) don't have or have besides."""
    model = saved_model(spark, sf_dir)
    logged = score_files(spark, model, paths, f"{root}/out", f"{root}/log", "config_check")
    stored = read_predictions_by_run(spark, f"{root}/out").join(logged.select("query_id", "input"), "query_id").drop("query_id")
    sides = stored.withColumn("copies", F.lit(1)).unionByName(score(model, trips, keep=["input"]).withColumn("copies", F.lit(-1)))
    alike = sides.groupBy("input", *S.PREDICTION_COLUMNS).agg(F.count_if(F.col("copies") > 0).alias("there"), F.sum("copies").alias("surplus"))
    counts = alike.groupBy("input").agg(F.sum("there").alias("rows"), F.sum(F.abs("surplus")).alias("differing"))
    zero = F.lit(0)
    return logged.join(counts, "input", "left").select(
        "input", "success", "config", F.coalesce("rows", zero).alias("rows"), F.coalesce("differing", zero).alias("differing")
    )


# Rows of the largest file that is damaged, and bytes of it that pass through the driver at a time.
DAMAGED_ROWS = 100_000
_PIECE = 1 << 16


def _damage(spark: SparkSession, folder: str) -> None:
    """Zeros in the middle of the largest of a Parquet folder's files, whose footer stays good; by Spark's own file system, piece by piece."""
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sizes = storage.part_sizes(spark, folder)
    name = max(sizes, key=sizes.get)
    half = sizes[name] // 2
    whole, out = fs.open(hadoop.fs.Path(path, name)), fs.create(hadoop.fs.Path(path, f".{name}"), True)
    out.write(whole.readNBytes(4))
    for at in range(4, half, _PIECE):
        out.write(bytes(min(_PIECE, half - at)))
    whole.seek(half)
    hadoop.io.IOUtils.copyBytes(whole, out, _PIECE, True)
    storage.replace(spark, f"{folder}/.{name}", f"{folder}/{name}")


_EVENT_KIND = "concat('kind=', event_type, '.parquet')"


def _mixed_inputs(spark: SparkSession, sf_dir: str, root: str) -> tuple[list[str], DataFrame]:
    """Parquet and CSV inputs at once, among them one without valid rows and one without a column, and their trips by input."""
    trips = V.view(spark, sf_dir, "events", {**V.TRIPS, "input": _EVENT_KIND})
    trips.withColumn("kind", F.substring_index("input", "=", -1)).drop("input").write.partitionBy("kind").parquet(f"{root}/in")
    events = V.event_trips(spark, sf_dir)
    some = events.filter("trip_id % 3 = 0")
    some.write.option("header", "true").csv(f"{root}/some.csv")
    events.filter("passenger_count = 0").write.option("header", "true").csv(f"{root}/idle.csv")
    events.drop("passenger_count").write.option("header", "true").csv(f"{root}/faceless.csv")
    paths = [*storage.expand(spark, f"{root}/in/kind=*"), f"{root}/some.csv", f"{root}/idle.csv", f"{root}/faceless.csv"]
    return paths, trips.unionByName(some.withColumn("input", F.lit("some.csv")))


def score_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed inputs and two whose damage shows only in the scan: every run as `score` has it, by value."""
    root = scratch_path(spark, "many-files")
    paths, trips = _mixed_inputs(spark, sf_dir, root)
    # Without columns that no scan reads: the damage has to lie in those it does.
    whole = V.event_trips(spark, sf_dir).select(*S.trip_columns(labelled=False))
    for k in range(2):
        whole.write.option("maxRecordsPerFile", DAMAGED_ROWS).parquet(f"{root}/damaged-{k}.parquet")
        _damage(spark, f"{root}/damaged-{k}.parquet")
    return _score_all(spark, sf_dir, [f"{root}/damaged-0.parquet", *paths, f"{root}/damaged-1.parquet"], root, trips)


def runlog_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest says of each input of a batch: trips read, valid and scored, counted in the scoring pass."""
    root = scratch_path(spark, "batch")
    paths, _ = _mixed_inputs(spark, sf_dir, root)
    score_files(spark, saved_model(spark, sf_dir), paths, f"{root}/out", f"{root}/log")
    runs = read_submissions(spark, f"{root}/out")
    return runs.select(F.substring_index("path", "/", -1).alias("input"), "input_rows", "valid_rows", "scored_rows", "success")


def folder_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of which one file lacks a column is logged as failed, beside one that is whole."""
    root = scratch_path(spark, "mixed")
    trips = V.event_trips(spark, sf_dir)
    trips.write.parquet(f"{root}/whole.parquet")
    trips.write.parquet(f"{root}/mixed.parquet")
    trips.drop("passenger_count").write.mode("append").parquet(f"{root}/mixed.parquet")
    paths = [f"{root}/whole.parquet", f"{root}/mixed.parquet"]
    return _score_all(spark, sf_dir, paths, root, trips.withColumn("input", F.lit("whole.parquet"))).drop("differing")


def score_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every monthly file scored in one job, each as `score` has it, by value."""
    root = scratch_path(spark, "months")
    trips = V.line_trips(spark, sf_dir)
    month = F.concat(F.date_format(S.PICKUP, "yyyy-MM"), F.lit(".parquet"))
    months = trips.withColumn("trips", month).hint("rebalance", "trips")
    months.write.partitionBy("trips").parquet(f"{root}/in")
    named = trips.withColumn("input", F.concat(F.lit("trips="), month))
    return _score_all(spark, sf_dir, storage.expand(spark, f"{root}/in/trips=*"), root, named)


def refused_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is asked of the inputs before any work: why each submission is refused, and the trips of the one that is not."""
    root, trips = scratch_path(spark, "refused"), V.event_trips(spark, sf_dir)
    good = f"{root}/trips.parquet"
    trips.write.parquet(good)
    trips.write.json(f"{root}/trips.json")
    cases = {"absent": [good, f"{root}/absent.parquet"], "suffix": [good, f"{root}/trips.json"], "twice": [good, good], "whole": [good]}
    rows = []
    for case, paths in cases.items():
        try:
            logged = score_files(spark, saved_model(spark, sf_dir), paths, f"{root}/{case}", f"{root}/log-{case}")
            rows.append((case, None, logged.count()))
        except (FileNotFoundError, ValueError) as error:
            rows.append((case, type(error).__name__, int(storage.exists(spark, f"{root}/log-{case}"))))
    outcomes = spark.createDataFrame(rows, "case string, refused string, logged long")
    valid = spark.range(1).select(F.lit(clean_trips(trips, labelled=False).count()).cast("long").alias("valid_rows"))
    return outcomes.crossJoin(F.broadcast(valid))


# Rows of the largest file that lands, so that no task that writes or mends one grows with the table.
LANDED_ROWS = 1_000_000


def _land(trips: DataFrame, landing: str, files: int) -> None:
    """Lands the trips as so many files or more, by the tasks that read them."""
    rows = min(LANDED_ROWS, max(1, math.ceil(trips.count() / files)))
    trips.write.mode("append").option("maxRecordsPerFile", rows).parquet(landing)


def _landed(spark: SparkSession, root: str) -> dict[str, int]:
    """The landed files' sizes, by name."""
    return storage.part_sizes(spark, f"{root}/landing")


def stream_intake_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landing in a folder, scored in two batches by a stream that drains it."""
    root = scratch_path(spark, "stream")
    trips = V.event_trips(spark, sf_dir)
    _land(trips, f"{root}/landing", 4)
    half = math.ceil(len(_landed(spark, root)) / 2)
    arriving = arriving_trips(spark, f"{root}/landing", trips.schema, files_per_batch=half)
    model = saved_model(spark, sf_dir)
    start_intake(model, arriving, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return _as_expected(read_predictions_by_run(spark, f"{root}/out", "parquet"), score(model, trips))


def _stream_against_batch(spark: SparkSession, root: str, model: PipelineModel, trips: DataFrame) -> DataFrame:
    """Rows the stream has stored, and how many of them, counting copies, a batch run has not or has besides."""
    streamed = read_predictions_by_run(spark, f"{root}/out", "parquet").drop("query_id")
    sides = streamed.withColumn("copies", F.lit(1)).unionByName(score(model, trips).withColumn("copies", F.lit(-1)))
    rows = sides.groupBy(*S.PREDICTION_COLUMNS).agg(
        F.count_if(F.col("copies") > 0).alias("streamed"), F.sum("copies").alias("surplus")
    )
    return rows.agg(F.sum("streamed").alias("streamed"), F.sum(F.abs("surplus")).alias("differing"))


def stream_batch_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of two batches and a batch run over the same trips: how many predictions differ, counting copies."""
    root = scratch_path(spark, "stream")
    trips = V.line_trips(spark, sf_dir)
    _land(trips, f"{root}/landing", 4)
    model = saved_model(spark, sf_dir)
    most = math.ceil(3 * len(_landed(spark, root)) / 4)
    arriving = arriving_trips(spark, f"{root}/landing", trips.schema, files_per_batch=most)
    start_intake(model, arriving, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return _stream_against_batch(spark, root, model, trips)


def _broken_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str, PipelineModel, DataFrame, Exception | None]:
    """A stream that has drained half of the line items when the rest lands, one file of it without a column; that file, and how it ended."""
    root, model, trips = scratch_path(spark, "stream"), saved_model(spark, sf_dir), V.line_trips(spark, sf_dir)
    _land(trips.filter("PULocationID % 2 = 0"), f"{root}/landing", 2)
    drained = _landed(spark, root)
    arriving = arriving_trips(spark, f"{root}/landing", trips.schema)
    start_intake(model, arriving, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    arriving = arriving_trips(spark, f"{root}/landing", trips.schema)
    _land(trips.filter("PULocationID % 2 <> 0"), f"{root}/landing", 1)
    sizes = {name: n for name, n in _landed(spark, root).items() if name not in drained}
    bad = max(sizes, key=sizes.get)
    # One file's rows: the whole one waits aside while the other has its name.
    whole = spark.read.schema(trips.schema).parquet(f"{root}/landing/{bad}").coalesce(1)
    whole.write.parquet(f"{root}/mended")
    whole.drop("passenger_count").write.parquet(f"{root}/faceless")
    storage.promote_part(spark, f"{root}/faceless", f"{root}/landing/{bad}")
    query = start_intake(model, arriving, f"{root}/out", f"{root}/checkpoint")
    try:
        query.awaitTermination()
        return root, bad, model, trips, None
    except StreamingQueryException as error:
        return root, bad, model, trips, error


def stream_layout_break(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file without a column lands among whole ones: the stream stops by its name, the batch uncommitted, nothing stored of it."""
    root, bad, model, trips, error = _broken_stream(spark, sf_dir)
    named = bad in str(error) and "passenger_count" in str(error)
    planned, done = (len([n for n in storage.children(spark, f"{root}/checkpoint/{kind}") if n.isdigit()]) for kind in ("offsets", "commits"))
    found = _stream_against_batch(spark, root, model, trips.filter("PULocationID % 2 = 0"))
    return found.select("*", F.lit(bool(error) and named).alias("named"), F.lit(planned - done).alias("uncommitted"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file is put right under its name and the stream started again: it ends with every row of all files, once."""
    root, bad, model, trips, _ = _broken_stream(spark, sf_dir)
    storage.promote_part(spark, f"{root}/mended", f"{root}/landing/{bad}")
    arriving = arriving_trips(spark, f"{root}/landing", trips.schema)
    start_intake(model, arriving, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return _stream_against_batch(spark, root, model, trips)


_LANDING_KIND = "CASE WHEN event_id % 8 = 0 THEN 'idle' ELSE event_type END"


def stream_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which landed files a stream has scored: one file per event type and one without a valid row."""
    root = scratch_path(spark, "stream")
    trips = V.view(spark, sf_dir, "events", {**V.TRIPS, "kind": _LANDING_KIND})
    trips.hint("rebalance", "kind").write.partitionBy("kind").parquet(f"{root}/landing")
    arriving = arriving_trips(spark, f"{root}/landing", trips.drop("kind").schema)
    start_intake(saved_model(spark, sf_dir), arriving, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    landed = landed_runs(spark, f"{root}/landing")
    status = result_catalogue(landed, stored_runs(spark, f"{root}/out"))
    kind = F.regexp_extract("path", "kind=([a-z]+)", 1).alias("kind")
    return landed.join(status, "query_id").select(kind, "status").distinct()


QUERIES = {
    "gbt_train_eval": gbt_train_eval,
    "gbt_evaluate": gbt_evaluate,
    "gbt_predict": gbt_predict,
    "hash_split_share": hash_split_share,
    "gbt_quality": gbt_quality,
    "model_round_trip": model_round_trip,
    "gbt_same_model_any_layout": gbt_same_model_any_layout,
    "score_one_file": score_one_file,
    "score_files": score_many_files,
    "folder_missing_column": folder_missing_column,
    "score_months": score_months,
    "stream_intake_score": stream_intake_score,
    "stream_batch_agreement": stream_batch_agreement,
    "stream_catalog": stream_catalog,
    "stream_layout_break": stream_layout_break,
    "stream_restart": stream_restart,
    "runlog_of_batch": runlog_of_batch,
    "refused_inputs": refused_inputs,
}

_UNLABELLED_SQL = V.cleaned_sql(labelled=False)

_FLAGGED_SQL = f"""SELECT trip_distance, PULocationID, DOLocationID, passenger_count, TRUE AS prediction
FROM ({_UNLABELLED_SQL}) AS cleaned"""

_KINDS_SQL = V.as_sql("events", {**V.TRIPS, "event_type": "event_type"})

_MONTHS_SQL = V.as_sql("lineitem", V.LINE_TRIPS)

_JUDGED_SQL = "count(*) AS trips, TRUE AS a_fifth_held_out, TRUE AS learned, TRUE AS errors_ordered, TRUE AS shares_ordered"

_VALID_COUNT_SQL = f"count(*) FILTER ({V.VALID_SQL})"

_EVEN_SQL = f"SELECT * FROM ({_MONTHS_SQL}) AS trips WHERE PULocationID % 2 = 0"

ORACLES = {
    "gbt_train_eval": f"SELECT {_JUDGED_SQL} FROM ({V.cleaned_sql()}) AS cleaned",
    "gbt_evaluate": f"SELECT {_JUDGED_SQL}, TRUE AS as_computed FROM ({V.cleaned_sql()}) AS cleaned",
    "gbt_predict": f"""SELECT trip_distance, PULocationID, DOLocationID, passenger_count, TRUE AS prediction, trip_id
FROM ({V.cleaned_sql(labelled=False, extra=", trip_id")}) AS cleaned""",
    "hash_split_share": f"""SELECT count(*) AS trips, TRUE AS fair
FROM (SELECT DISTINCT * FROM ({V.cleaned_sql(_MONTHS_SQL)}) AS cleaned) AS rows""",
    "stream_layout_break": f"""SELECT count(*) AS streamed, CAST(0 AS BIGINT) AS differing, TRUE AS named, 1 AS uncommitted
FROM ({V.cleaned_sql(_EVEN_SQL, labelled=False)}) AS cleaned""",
    "stream_restart": f"""SELECT count(*) AS streamed, CAST(0 AS BIGINT) AS differing
FROM ({V.cleaned_sql(_MONTHS_SQL, labelled=False)}) AS cleaned""",
    "runlog_of_batch": f"""SELECT concat('kind=', event_type, '.parquet') AS input, count(*) AS input_rows, {_VALID_COUNT_SQL} AS valid_rows,
  {_VALID_COUNT_SQL} AS scored_rows, {_VALID_COUNT_SQL} > 0 AS success FROM ({_KINDS_SQL}) AS kinds GROUP BY event_type
UNION ALL SELECT 'some.csv', count(*), {_VALID_COUNT_SQL}, {_VALID_COUNT_SQL}, {_VALID_COUNT_SQL} > 0
FROM ({V.trips_sql()}) AS trips WHERE trip_id % 3 = 0
UNION ALL SELECT 'idle.csv', count(*), 0, 0, FALSE FROM ({V.trips_sql()}) AS trips WHERE passenger_count = 0
UNION ALL SELECT 'faceless.csv', NULL, 0, 0, FALSE""",
    "refused_inputs": f"""SELECT c."case", c.refused, c.logged, v.valid_rows
FROM (VALUES ('absent', 'FileNotFoundError', 0::BIGINT), ('suffix', 'ValueError', 0), ('twice', 'ValueError', 0), ('whole', NULL, 1)) AS c("case", refused, logged),
  (SELECT count(*) AS valid_rows FROM ({_UNLABELLED_SQL}) AS cleaned) AS v""",
    "gbt_quality": f"""SELECT count(*) AS test_records, TRUE AS learned, TRUE AS rmse_agrees, TRUE AS r2_agrees,
  TRUE AS mae_agrees, TRUE AS shares_ordered
FROM ({V.cleaned_sql(extra=", trip_id")}) AS cleaned WHERE (trip_id * 7919 + 104729) % 100 >= 80""",
    "stream_batch_agreement": f"""SELECT count(*) AS streamed, CAST(0 AS BIGINT) AS differing
FROM ({V.cleaned_sql(_MONTHS_SQL, labelled=False)}) AS cleaned""",
    "gbt_same_model_any_layout": f"SELECT count(*) AS trips, CAST(0 AS BIGINT) AS differing, TRUE AS same_bins FROM ({V.cleaned_sql()}) AS cleaned",
    "model_round_trip": f'SELECT count(*) AS trips, count(*) AS "equal" FROM ({V.cleaned_sql()}) AS cleaned',
    "score_one_file": _FLAGGED_SQL,
    "score_files": f"""SELECT concat('kind=', event_type, '.parquet') AS input, {_VALID_COUNT_SQL} > 0 AS success,
  'config_check' AS config, {_VALID_COUNT_SQL} AS "rows", CAST(0 AS BIGINT) AS differing FROM ({_KINDS_SQL}) AS kinds GROUP BY event_type
UNION ALL SELECT 'some.csv', {_VALID_COUNT_SQL} > 0, 'config_check', {_VALID_COUNT_SQL}, 0
FROM ({V.trips_sql()}) AS trips WHERE trip_id % 3 = 0
UNION ALL SELECT n, FALSE, 'config_check', 0, 0
FROM (VALUES ('idle.csv'), ('faceless.csv'), ('damaged-0.parquet'), ('damaged-1.parquet')) AS v(n)""",
    "folder_missing_column": f"""SELECT 'whole.parquet' AS input, count(*) > 0 AS success, 'config_check' AS config, count(*) AS "rows"
FROM ({_UNLABELLED_SQL}) AS cleaned
UNION ALL SELECT 'mixed.parquet', FALSE, 'config_check', 0""",
    "score_months": f"""SELECT concat('trips=', strftime(tpep_pickup_datetime, '%Y-%m'), '.parquet') AS input,
  count(*) FILTER ({V.VALID_SQL}) > 0 AS success, 'config_check' AS config, count(*) FILTER ({V.VALID_SQL}) AS "rows", CAST(0 AS BIGINT) AS differing
FROM ({_MONTHS_SQL}) AS trips GROUP BY 1""",
    "stream_intake_score": _FLAGGED_SQL,
    "stream_catalog": f"""SELECT kind, CASE WHEN count(*) FILTER ({V.VALID_SQL}) > 0 THEN 'complete' ELSE 'no results' END AS status
FROM ({V.as_sql("events", {**V.TRIPS, "kind": _LANDING_KIND})}) AS trips
GROUP BY kind""",
}
