"""Typing, calendar parts and the row rules."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.functions.parsing import to_long
from fareflow.operators.features import clean_trips, typed_trips, with_calendar

NATIVE = (
    "case string, tpep_pickup_datetime timestamp_ntz, trip_distance double, passenger_count double, "
    "fare_amount double, PULocationID bigint, DOLocationID bigint"
)
WHEN = datetime(2022, 6, 15, 8, 30)
BASE = dict(distance=2.5, passengers=1.0, fare=12.0, pickup=132, dropoff=138, when=WHEN)

# (case, changes, kept as labelled, kept as unlabelled)
CASES = [
    ("ordinary", {}, True, True),
    ("fare 0", {"fare": 0.0}, False, True),
    ("fare 150", {"fare": 150.0}, False, True),
    ("fare 0.01", {"fare": 0.01}, True, True),
    ("fare 149.99", {"fare": 149.99}, True, True),
    ("fare NULL", {"fare": None}, False, True),
    ("fare NaN", {"fare": math.nan}, False, True),
    ("distance 0", {"distance": 0.0}, False, False),
    ("distance negative", {"distance": -1.0}, False, False),
    ("distance NULL", {"distance": None}, False, False),
    ("distance NaN", {"distance": math.nan}, False, False),
    ("distance infinite", {"distance": math.inf}, True, True),
    ("passengers 0", {"passengers": 0.0}, False, False),
    ("passengers 7", {"passengers": 7.0}, False, False),
    ("passengers 6", {"passengers": 6.0}, True, True),
    ("passengers NULL", {"passengers": None}, False, False),
    ("passengers NaN", {"passengers": math.nan}, False, False),
    ("time NULL", {"when": None}, False, False),
    ("zone NULL", {"pickup": None}, False, False),
    ("dropoff NULL", {"dropoff": None}, False, False),
    ("zone 999", {"dropoff": 999}, True, True),
]


def _row(case, changes):
    v = {**BASE, **changes}
    return (case, v["when"], v["distance"], v["passengers"], v["fare"], v["pickup"], v["dropoff"])


@pytest.fixture(scope="module")
def edge_rows(spark):
    return spark.createDataFrame([_row(case, changes) for case, changes, _, _ in CASES], NATIVE)


@pytest.mark.parametrize("labelled", [True, False])
def test_rules(edge_rows, labelled):
    kept = {r["case"] for r in clean_trips(edge_rows, labelled, keep=["case"]).collect()}
    assert kept == {case for case, _, with_fare, without in CASES if (with_fare if labelled else without)}


@pytest.mark.parametrize("labelled", [True, False])
def test_rules_on_whole_number_columns(spark, labelled):
    """Integer columns are compared before their cast; the outcome is the same."""
    rows = [(i, WHEN, d, p, f, 1, 2) for i, (d, p, f) in enumerate(
        [(0, 1, 10), (1, 0, 10), (1, 6, 10), (1, 7, 10), (1, 1, 0), (1, 1, 149), (1, 1, 150), (None, 1, 10)]
    )]
    whole = spark.createDataFrame(
        rows,
        "case int, tpep_pickup_datetime timestamp_ntz, trip_distance int, passenger_count bigint, "
        "fare_amount int, PULocationID int, DOLocationID smallint",
    )
    floating = whole.withColumns({c: F.col(c).cast("double") for c in ("trip_distance", "passenger_count", "fare_amount")})
    results = [sorted(clean_trips(df, labelled, keep=["case"]).collect()) for df in (whole, floating)]
    assert results[0] == results[1]
    assert [r["case"] for r in clean_trips(whole, labelled, keep=["case"]).orderBy("case").collect()] == (
        [2, 5] if labelled else [2, 4, 5, 6]
    )


def test_cleaned_schema(edge_rows):
    assert [(f.name, f.dataType) for f in clean_trips(edge_rows).schema] == [
        (f.name, f.dataType) for f in S.CLEANED.fields
    ]
    unlabelled = clean_trips(edge_rows.drop("fare_amount"), labelled=False)
    assert tuple(unlabelled.columns) == S.FEATURE_COLUMNS


def test_unreadable_text_becomes_null(spark):
    text = spark.createDataFrame(
        [("notadate", "abc", "x", "1,5", "132.0"), ("2022-06-18 07:30:00", " 2.5 ", "1.0", "7", "12.9")],
        "tpep_pickup_datetime string, trip_distance string, passenger_count string, PULocationID string, DOLocationID string",
    )
    bad, good = typed_trips(text, labelled=False).collect()
    assert (bad.tpep_pickup_datetime, bad.trip_distance, bad.passenger_count, bad.PULocationID) == (None,) * 4
    assert bad.DOLocationID == 132
    assert (good.trip_distance, good.passenger_count, good.PULocationID, good.DOLocationID) == (2.5, 1.0, 7, 12)


@pytest.mark.parametrize(
    "text, value",
    [("132", 132), ("132.0", 132), (" 7. ", 7), ("-4.9", -4), ("9007199254740993", 9007199254740993),
     ("9007199254740993.0", 9007199254740993), ("", None), ("1e2", None), ("12x", None), ("99999999999999999999", None)],
)
def test_whole_numbers_from_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_long(F.col("t"), df.schema["t"].dataType)).first()[0] == value


def test_calendar(spark):
    days = spark.createDataFrame(
        [(datetime(2022, 6, 18, 23, 59, 59),), (datetime(2022, 6, 19, 0, 0),), (datetime(2023, 12, 31, 12, 0),)],
        "tpep_pickup_datetime timestamp_ntz",
    )
    parts = [tuple(r)[1:] for r in with_calendar(days, year=True).collect()]
    assert parts == [(23, 7, 6, 2022), (0, 1, 6, 2022), (12, 1, 12, 2023)]


def test_calendar_is_the_same_for_zoned_and_local_times(spark):
    text = spark.createDataFrame([("2022-06-15 08:30:00",)], "t string")
    zoned = text.select(F.col("t").cast("timestamp").alias(S.PICKUP))
    local = text.select(F.col("t").cast("timestamp_ntz").alias(S.PICKUP))
    assert with_calendar(zoned).first()[1:] == with_calendar(local).first()[1:] == (8, 4, 6)


def test_cleaning_is_one_pushed_down_stage(spark, edge_rows, tmp_path):
    """No exchange, no Python, and every rule at the scan, also on whole-number columns."""
    edge_rows.withColumn("passenger_count", F.col("passenger_count").try_cast("bigint")).write.parquet(str(tmp_path / "t"))
    plan = clean_trips(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "Exchange" not in plan and "Python" not in plan
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for rule in ("GreaterThan(trip_distance,0.0)", "GreaterThan(passenger_count,0)", "LessThanOrEqual(passenger_count,6)",
                 "GreaterThan(fare_amount,0.0)", "LessThan(fare_amount,150.0)", "IsNotNull(PULocationID)",
                 "IsNotNull(tpep_pickup_datetime)"):
        assert rule in pushed
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "case" not in read


TEXTS = """132|132.0|132.9| 132 |132. |+7|-7.9|-0|| |+|1e2|1.5e3|12 3|0x1A|1_000|NaN|nan|inf|Infinity|-inf|1.5f|1d|abc|null
9223372036854775807|9223372036854775808|-9223372036854775808|9007199254740993.0|99999999999999999999.0|1,5|\t5\t
2022-06-15 08:30:00|2022-06-15|2022-06|2022|08:30:00|T08:30|2022-06-15T08:30:00Z|2022-06-15 08:30:00.123|2022-06-15 08:30
2022-6-5 8:3:0|2022-06-15 25:00:00|notadate|15/06/2022 08:30| 2022-06-15 08:30:00 |2022-06-15 08:30:00 UTC|2022-02-30 08:30:00"""


def test_text_is_read_as_lenient_casts_read_it(spark):
    """The published results come from casts that yield NULL; ours must agree while errors are on."""
    texts = [text for line in TEXTS.split("\n") for text in line.split("|")]
    rows = spark.createDataFrame([(text,) * 4 for text in texts], "text string, trip_distance string, PULocationID string, t string")
    trips = rows.selectExpr("*", "'1' AS passenger_count", "'1' AS DOLocationID", "t AS tpep_pickup_datetime")
    typed = typed_trips(trips, labelled=False, keep=["text"]).transform(with_calendar)
    dated = F.col("tpep_pickup_datetime").isNotNull()
    mine = typed.select("text", "trip_distance", "PULocationID", *[F.when(dated, F.col(c)) for c in ("hour", "day_of_week", "month")]).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        parts = [F.hour("t"), F.dayofweek("t"), F.month("t")]
        complete = parts[0].isNotNull() & parts[1].isNotNull()
        lenient = rows.select(
            "text", F.col("trip_distance").cast("double"), F.col("PULocationID").cast("bigint"), *[F.when(complete, p) for p in parts]
        ).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert list(map(repr, map(tuple, mine))) == list(map(repr, map(tuple, lenient)))
