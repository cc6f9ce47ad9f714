"""Inputs that the queries make for themselves: none grows, with the table, in what one task or the driver holds."""

import tracemalloc

import pytest
from pyspark.sql import functions as F

from fareflow.checks import models
from fareflow.checks import views as V
from fareflow.operators.features import clean_trips
from fareflow.operators.model import fit_fares
from fareflow.sources import storage


class Stop(Exception):
    pass


def _stop(*_args, **_kwargs):
    raise Stop


def _rows_of_files(spark, folder):
    files = spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("rows"))
    return {row.name: row.rows for row in files.collect()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    events = spark.range(0, 2000, 1, 2).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1654041600) + F.col("id") * 611).cast("timestamp_ntz").alias("ts"),
        (1 + F.col("id") % 263).alias("user_id"),
        F.element_at(F.array(F.lit("view"), F.lit("buy")), (F.col("id") % 2 + 1).cast("int")).alias("event_type"),
        (F.lit(0.5) + F.col("id") * 7919 % 1999 / 20).alias("value"),
        F.concat(F.lit('{"k": '), 1 + F.col("id") % 131, F.lit("}")).alias("props"),
    )
    events.write.parquet(str(root / "events.parquet"))
    return str(root)


def test_what_is_damaged_is_bounded(spark, tables, monkeypatch):
    damaged = []
    monkeypatch.setattr(models, "DAMAGED_ROWS", 300, raising=False)
    monkeypatch.setattr(models, "_damage", lambda spark, folder: damaged.append(folder))
    monkeypatch.setattr(models, "_score_all", _stop)
    with pytest.raises(Stop):
        models.score_many_files(spark, tables)
    assert len(damaged) == 2
    for folder in damaged:
        rows = _rows_of_files(spark, folder)
        assert sum(rows.values()) == 2000
        assert max(rows.values()) <= 300


def test_damage_shows_where_keys_take_most_of_the_file(spark, tmp_path):
    events = spark.range(0, 60_000, 1, 2).select(
        F.xxhash64("id").alias("event_id"),
        F.lit("2022-06-01 10:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit(7).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(20.0).alias("value"),
        F.lit('{"k": 5}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    model = fit_fares(clean_trips(V.event_trips(spark, str(tmp_path)), labelled=True), partitions=2, max_iter=1)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(models, "saved_model", lambda *_: model)
        rows = {row.input: row for row in models.score_many_files(spark, str(tmp_path)).collect()}
    assert rows["kind=view.parquet"].success and rows["kind=view.parquet"].differing == 0
    assert [(rows[f"damaged-{k}.parquet"].success, rows[f"damaged-{k}.parquet"].rows) for k in range(2)] == [(False, 0)] * 2


def test_one_of_many_files_is_damaged(spark, tmp_path):
    folder = str(tmp_path / "trips.parquet")
    spark.range(0, 4000, 1, 4).withColumn("half", F.col("id") / 2).write.parquet(folder)
    parts = sorted((tmp_path / "trips.parquet").glob("part-*"))
    before = [part.read_bytes() for part in parts]
    models._damage(spark, folder)
    after = [part.read_bytes() for part in parts]
    assert sum(a != b for a, b in zip(after, before)) == 1
    assert [len(a) for a in after] == [len(b) for b in before]
    assert storage.parquet_columns(spark, folder + "/" + parts[0].name) == ["id", "half"]
    assert spark.read.parquet(folder).count() == 4000
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        spark.read.parquet(folder).agg(F.sum("half")).collect()


def test_the_damaged_file_is_not_held_by_the_driver(spark, tmp_path):
    folder = str(tmp_path / "trips.parquet")
    spark.range(0, 1_000_000, 1, 1).select(F.rand(3).alias("a"), F.rand(4).alias("b")).write.parquet(folder)
    (part,) = (tmp_path / "trips.parquet").glob("part-*")
    before = part.read_bytes()
    tracemalloc.start()
    models._damage(spark, folder)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    half = len(before) // 2
    assert half > 5_000_000 > 5 * most
    assert part.read_bytes() == before[:4] + bytes(half - 4) + before[half:]
    assert [x.name for x in (tmp_path / "trips.parquet").iterdir() if "part-" in x.name and not x.name.endswith(".crc")] == [part.name]


class Drained:
    def awaitTermination(self):
        return True


def _lines(spark, root):
    lines = spark.range(0, 4000, 1, 3).select(
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") % 10).alias("l_suppkey"),
        (F.col("id") % 200).alias("l_partkey"),
        (F.col("id") % 9000 + 900).cast("double").alias("l_extendedprice"),
        F.timestamp_seconds(F.lit(820454400) + F.col("id") * 3611).cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.write.parquet(str(root / "lineitem.parquet"))
    return str(root)


def test_what_lands_while_the_stream_runs_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "LANDED_ROWS", 300, raising=False)
    monkeypatch.setattr(models, "saved_model", lambda *_: None)
    monkeypatch.setattr(models, "start_intake", lambda *_, **__: Drained())
    root = models._broken_stream(spark, _lines(spark, tmp_path))[0]
    rows = _rows_of_files(spark, f"{root}/landing")
    assert sum(rows.values()) == 4000
    assert max(rows.values()) <= 300
    lacking = [name for name in rows if "passenger_count" not in storage.parquet_columns(spark, f"{root}/landing/{name}")]
    assert len(lacking) == 1
    mended = spark.read.parquet(f"{root}/mended")
    assert mended.count() == rows[lacking[0]] and "passenger_count" in mended.columns


@pytest.mark.parametrize("name", ["stream_layout_break", "stream_restart"])
def test_a_broken_stream_of_many_files(spark, tables, tmp_path, monkeypatch, name):
    model = fit_fares(clean_trips(V.event_trips(spark, tables), labelled=True), partitions=2, max_iter=1)
    monkeypatch.setattr(models, "LANDED_ROWS", 300, raising=False)
    monkeypatch.setattr(models, "saved_model", lambda *_: model)
    lines = _lines(spark, tmp_path)
    trips = clean_trips(V.line_trips(spark, lines), labelled=False)
    row = models.QUERIES[name](spark, lines).first()
    if name == "stream_restart":
        assert (row.streamed, row.differing) == (trips.count(), 0)
    else:
        assert (row.streamed, row.differing, row.named, row.uncommitted) == (trips.filter("PULocationID % 2 = 0").count(), 0, True, 1)


@pytest.mark.parametrize("most", [300, 10_000])
def test_two_batches_of_bounded_files(spark, tmp_path, monkeypatch, most):
    seen = []

    def stop(_spark, landing, *_args, files_per_batch, **_kwargs):
        seen.extend([landing, files_per_batch])
        raise Stop

    monkeypatch.setattr(models, "LANDED_ROWS", most, raising=False)
    monkeypatch.setattr(models, "saved_model", lambda *_: None)
    monkeypatch.setattr(models, "arriving_trips", stop)
    with pytest.raises(Stop):
        models.stream_batch_agreement(spark, _lines(spark, tmp_path))
    landing, batch = seen
    rows = _rows_of_files(spark, landing)
    assert sum(rows.values()) == 4000
    assert max(rows.values()) <= min(most, 1000)
    assert len(rows) / 2 <= batch < len(rows)
