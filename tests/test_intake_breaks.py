"""Files that break the layout while a stream runs."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.operators.features import clean_trips
from fareflow.operators.model import fit_fares
from fareflow.plans.scoring import score
from fareflow.sources import storage
from fareflow.sources.heads import _head, file_heads
from fareflow.sources.tables import read_predictions_by_run
from fareflow.sources.trips import UnreadableTrips, look_up
from fareflow.streaming.intake import arriving_trips, start_intake


@pytest.fixture(scope="module")
def trips(spark):
    return spark.range(0, 900, 1, 3).select(
        F.timestamp_seconds(F.lit(1654041600) + F.col("id") * 611).cast("timestamp_ntz").alias(S.PICKUP),
        (F.lit(0.5) + F.col("id") % 97 / 10).alias("trip_distance"),
        (1 + F.col("id") % 6).alias("passenger_count"),
        (3 + F.col("id") % 97 / 4).alias("fare_amount"),
        (1 + F.col("id") % 263).alias("PULocationID"),
        (1 + F.col("id") % 131).alias("DOLocationID"),
    )


@pytest.fixture(scope="module")
def model(trips):
    return fit_fares(clean_trips(trips, labelled=True), max_iter=2)


@pytest.mark.parametrize("column", ["passenger_count", S.PICKUP])
def test_a_file_without_a_column_stops_the_stream_and_loses_nothing(spark, trips, model, tmp_path, column):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    first, second = trips.filter("PULocationID % 2 = 0"), trips.filter("PULocationID % 2 = 1")
    first.coalesce(1).write.parquet(landing)
    arriving = arriving_trips(spark, landing, trips.schema)
    # Lands after the stream was looked over.
    second.drop(column).coalesce(1).write.mode("append").parquet(landing)
    with pytest.raises(StreamingQueryException, match=f"part-.*missing columns {column}"):
        start_intake(model, arriving, root, checkpoint).awaitTermination()
    assert not (tmp_path / "out").exists() and not list((tmp_path / "cp" / "commits").glob("[0-9]*"))
    with pytest.raises(UnreadableTrips, match="part-"):
        arriving_trips(spark, landing, trips.schema)

    (bad,) = [p for p in (tmp_path / "in").glob("part-*.parquet") if column not in spark.read.parquet(str(p)).columns]
    second.coalesce(1).write.parquet(str(tmp_path / "mended"))
    storage.promote_part(spark, str(tmp_path / "mended"), str(bad))
    for _ in range(2):
        start_intake(model, arriving_trips(spark, landing, trips.schema), root, checkpoint).awaitTermination()
        stored = read_predictions_by_run(spark, root, "parquet").drop("query_id")
        assert sorted(stored.collect()) == sorted(score(model, trips).collect())


def test_a_batch_run_again_leaves_its_rows_once(spark, trips, model, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    trips.repartition(3).write.parquet(landing)
    # Another checkpoint knows of nothing: every file is scored again.
    for attempt in range(2):
        start_intake(model, arriving_trips(spark, landing, trips.schema), root, str(tmp_path / f"cp{attempt}")).awaitTermination()
    assert read_predictions_by_run(spark, root, "parquet").count() == 900


def test_the_folder_of_a_file_sink_is_refused(spark, trips, model, tmp_path):
    trips.write.parquet(str(tmp_path / "in"))
    (tmp_path / "out" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="file sink"):
        start_intake(model, arriving_trips(spark, str(tmp_path / "in"), trips.schema), str(tmp_path / "out"), str(tmp_path / "cp"))


def test_heads_agree_with_spark(spark, tmp_path):
    kinds = ["boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "string", "binary", "date", "timestamp", "timestamp_ntz", "decimal(9,2)", "decimal(30,4)"]
    df = spark.range(5).select(*[F.lit(None).cast(k).alias(f"c{i}") for i, k in enumerate(kinds)], F.array(F.lit(1)).alias("many"))
    for zone in ("INT96", "TIMESTAMP_MICROS", "TIMESTAMP_MILLIS"):
        spark.conf.set("spark.sql.parquet.outputTimestampType", zone)
        df.coalesce(1).write.parquet(str(tmp_path / f"{zone}.parquet"))
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    for path in tmp_path.glob("*.parquet/part-*.parquet"):
        files = spark.createDataFrame([(storage.uri(spark, str(path)), "parquet")], "file string, format string")
        head = file_heads(files).first()
        assert head.rows == 5 and not head.unsure
        assert list(zip(head.names, head.types))[:-1] == [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(str(path)).schema][:-1]
        assert head.types[-1] is None


def test_heads_of_text_files(tmp_path):
    def head(data):
        (tmp_path / "t.csv").write_bytes(data)
        return _head(f"file:{tmp_path}/t.csv", "csv")

    assert head(b"a,b\r\n1,2\n")["names"] == ["a", "b"]
    assert head(b"a,,A,b")["names"] == ["a0", "_c1", "A2", "b"]
    assert head(b"")["names"] == []
    for odd in (b'"a",b\n', b"\n\na,b\n", b"\xef\xbb\xbfa,b\n", b"\xff\xfe\n", b"x" * 70_000):
        assert head(odd) == {"unsure": True}
    assert _head("nosuchstore://host/a.parquet", "parquet") == {"unsure": True}
    assert _head(f"file:{tmp_path}/none.parquet", "parquet") == {"unsure": True}


def test_a_thousand_paths_are_one_look_up(spark, tmp_path):
    header = "trip_distance,PULocationID,DOLocationID,passenger_count,tpep_pickup_datetime"
    for i in range(1000):
        (tmp_path / f"{i}.csv").write_text(f"{header if i % 3 else ','.join(reversed(header.split(',')))}\n1,2,3,4,5\n")
    (tmp_path / "lacking.csv").write_text("a,b\n")
    paths = [str(tmp_path / f"{i}.csv") for i in range(1000)] + [str(tmp_path / "lacking.csv")]
    found = look_up(spark, paths, labelled=False)
    assert list(found) == paths and isinstance(found[paths[-1]][0], UnreadableTrips)
    assert len({layout for layout, _ in found.values() if not isinstance(layout, UnreadableTrips)}) == 2
