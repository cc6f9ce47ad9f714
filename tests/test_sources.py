"""Reading trips whose files disagree, and the existence and format checks."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.plans.preprocess import preprocess_months
from fareflow.sources import storage
from fareflow.sources.run_log import append_run_log, compact_run_log, read_run_log
from fareflow.sources.tables import (
    export_predictions,
    read_cleaned,
    read_predictions,
    write_cleaned,
    write_predictions,
)
from fareflow.sources.trips import (
    UnreadableTrips,
    check_inputs,
    group_layouts,
    input_format,
    month_paths,
    read_clean_trips,
    read_trips,
)

WHEN = datetime(2022, 6, 15, 8, 30)
HEADER = "trip_distance,PULocationID,DOLocationID,passenger_count,tpep_pickup_datetime"


def _csv(tmp_path, name, *lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def _month(spark, path, rows=1, **types):
    """A month with an explicit stored type per column."""
    df = spark.range(rows).select(
        F.lit(WHEN).cast("timestamp_ntz").alias(S.PICKUP),
        (F.col("id") + 2).cast(types.get("distance", "double")).alias("trip_distance"),
        F.lit(1).cast(types.get("passengers", "double")).alias("passenger_count"),
        F.lit(10).cast(types.get("fare", "double")).alias("fare_amount"),
        F.lit(132).cast(types.get("zone", "bigint")).alias("PULocationID"),
        F.lit(138).cast(types.get("zone", "bigint")).alias("DOLocationID"),
        F.lit("x").alias("store_and_fwd_flag"),
    )
    df.coalesce(1).write.parquet(str(path))


def _values(df):
    return sorted((r.trip_distance, r.PULocationID, r.DOLocationID, r.passenger_count) for r in df.collect())


def test_csv_is_bound_by_name_in_each_file(spark, tmp_path):
    paths = [
        _csv(tmp_path, "a.csv", HEADER, "3.7,41,66,1,2022-03-08 06:20:00"),
        _csv(tmp_path, "b.csv", "passenger_count,DOLocationID,PULocationID,trip_distance,tpep_pickup_datetime",
             "2,88,12,6.4,2022-03-08 21:10:00"),
        _csv(tmp_path, "c.csv", HEADER.lower(), "0.8,5,9,3,2022-03-08 13:40:00"),
        _csv(tmp_path, "d.csv", "," + HEADER + ",note,note", "0,9.9,70,2,4,2022-03-08 23:05:00,p,q"),
    ]
    assert _values(read_clean_trips(spark, paths, labelled=False)) == [
        (0.8, 5, 9, 3.0), (3.7, 41, 66, 1.0), (6.4, 12, 88, 2.0), (9.9, 70, 2, 4.0)
    ]


def test_csv_rows_that_cannot_be_read_are_dropped(spark, tmp_path):
    path = _csv(
        tmp_path, "t.csv", HEADER,
        "3.7,41.0,66,1,2022-03-08 06:20:00", "abc,41,66,1,2022-03-08 06:20:00", "3.7,41,66,1,notadate",
        "3.7,,66,1,2022-03-08 06:20:00", "3.7,41", ",,,,", "3.7,41,66,7,2022-03-08 06:20:00",
    )
    assert _values(read_clean_trips(spark, [path], labelled=False)) == [(3.7, 41, 66, 1.0)]


def test_csv_directory_with_two_headers_is_refused_not_swapped(spark, tmp_path):
    folder = tmp_path / "trips.csv"
    folder.mkdir()
    _csv(folder, "part-0.csv", HEADER, "3.7,41,66,1,2022-03-08 06:20:00")
    _csv(folder, "part-1.csv", "DOLocationID,PULocationID,trip_distance,passenger_count,tpep_pickup_datetime",
         "88,12,6.4,2,2022-03-08 21:10:00")
    with pytest.raises(Exception, match="(?i)header"):
        read_clean_trips(spark, [str(folder)], labelled=False).collect()


def test_drifting_types_become_one_table(spark, tmp_path):
    drift = [{}, {"passengers": "bigint"}, {"passengers": "bigint"}, {"zone": "double", "distance": "float"},
             {"zone": "int", "fare": "decimal(10,2)"}, {"zone": "string", "distance": "string"}]
    for month, types in enumerate(drift, 1):
        _month(spark, tmp_path / f"yellow_tripdata_2022-{month:02d}.parquet", rows=month, **types)
    paths = month_paths(spark, str(tmp_path), [2021, 2022, 2023])
    assert len(paths) == len(drift)
    groups = group_layouts(spark, paths, labelled=True)
    assert sorted(len(members) for members in groups.values()) == [1, 1, 1, 1, 2]
    cleaned = preprocess_months(spark, str(tmp_path), [2022], str(tmp_path / "cleaned"))
    assert cleaned.columns == list(S.CLEANED_COLUMNS)
    stored = read_cleaned(spark, str(tmp_path / "cleaned"))
    assert stored.schema == S.CLEANED
    assert stored.count() == sum(range(1, len(drift) + 1))
    assert stored.select("PULocationID", "passenger_count", "fare_amount").distinct().collect() == [(132, 1.0, 10.0)]


def test_month_without_any_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        month_paths(spark, str(tmp_path), [2022])


def test_column_missing_in_one_month(spark, tmp_path):
    _month(spark, tmp_path / "a.parquet")
    spark.read.parquet(str(tmp_path / "a.parquet")).drop("passenger_count").write.parquet(str(tmp_path / "b.parquet"))
    with pytest.raises(UnreadableTrips, match="passenger_count"):
        read_trips(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")], labelled=True)


def test_column_missing_in_one_file_of_a_folder(spark, tmp_path):
    folder = str(tmp_path / "a.parquet")
    _month(spark, tmp_path / "a.parquet")
    assert read_trips(spark, [folder], labelled=True).count() > 0
    spark.read.parquet(folder).drop("passenger_count").write.mode("append").parquet(folder)
    with pytest.raises(UnreadableTrips, match="part-.*passenger_count"):
        read_trips(spark, [folder], labelled=True)


def test_unreadable_paths(spark, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"not a parquet file at all")
    for path in (empty, broken):
        with pytest.raises(UnreadableTrips):
            read_trips(spark, [str(path)])


def test_suffix_and_existence(spark, tmp_path):
    assert input_format("/x/a.csv") == "csv" and input_format("hdfs://h/a.parquet/") == "parquet"
    with pytest.raises(ValueError):
        input_format("a.json")
    with pytest.raises(FileNotFoundError):
        check_inputs(spark, [str(tmp_path / "none.csv")])


def test_uri_matches_the_scan(spark, tmp_path):
    folder = tmp_path / "sp ace%"
    folder.mkdir()
    path = _csv(folder, "x y.csv", HEADER, "1,2,3,4,5")
    seen = spark.read.option("header", "true").csv(path).select("_metadata.file_path").first()[0]
    assert storage.uri(spark, path) == seen
    assert [p.rsplit("/", 1)[1] for p in storage.expand(spark, f"{folder}/*.csv")] == ["x y.csv"]
    assert storage.expand(spark, f"{folder}/*.orc") == []


def test_by_month_layout_prunes_and_keeps_every_row(spark, tmp_path):
    rows = [(1.0 + i, 1, 2, 1.0, 5, 3, 1 + i % 3, 9.0, 2020 + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, [*S.CLEANED_COLUMNS, "year"])
    df = df.withColumns({c: F.col(c).cast("int") for c in ("hour", "day_of_week", "month", "year")})
    write_cleaned(df, str(tmp_path / "c"), by_month=True)
    assert read_cleaned(spark, str(tmp_path / "c")).count() == 60
    year = read_cleaned(spark, str(tmp_path / "c"), years=[2021])
    assert year.schema.names == list(S.CLEANED_COLUMNS) and year.count() == 30
    write_cleaned(df.select(*S.CLEANED_COLUMNS), str(tmp_path / "plain"))
    with pytest.raises(ValueError):
        read_cleaned(spark, str(tmp_path / "plain"), years=[2021])
    assert "PartitionFilters: [year" in year._jdf.queryExecution().toString().replace("isnotnull(year", "year")


def test_run_log_appends_with_one_schema(spark, tmp_path):
    row = [("2031-05-06 07:08:09", "query_1", "a.parquet", 12.25, True, "config_A")]
    log = spark.createDataFrame(row, S.RUN_LOG)
    for _ in range(2):
        append_run_log(log, str(tmp_path / "log"))
    stored = read_run_log(spark, str(tmp_path / "log"))
    assert stored.schema == S.RUN_LOG and stored.collect() == log.collect() * 2


def _log(spark, *ids):
    return spark.createDataFrame([("2026-05-01 10:00:00", f"query_{i}", "a.csv", 1.5, True, "config_A") for i in ids], S.RUN_LOG)


def _ids(spark, path):
    return sorted(int(r.query_id[6:]) for r in read_run_log(spark, path).collect())


def test_a_merged_log_reads_the_same_from_fewer_files(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(12):
        append_run_log(_log(spark, i), path)
    assert compact_run_log(spark, path) == 12
    assert _ids(spark, path) == list(range(12)) and len(read_run_log(spark, path).inputFiles()) == 1
    for i in range(12, 15):
        append_run_log(_log(spark, i), path)
    assert _ids(spark, path) == list(range(15)) and len(read_run_log(spark, path).inputFiles()) == 4
    assert compact_run_log(spark, path) == 4
    # What the first merge had read goes with the second.
    assert len(list((tmp_path / "log").glob("submission-*"))) == 3
    assert compact_run_log(spark, path) == 0
    append_run_log(_log(spark, 15), path)
    assert compact_run_log(spark, path, full_bytes=1) == 0
    assert compact_run_log(spark, path) == 2
    assert _ids(spark, path) == list(range(16)) and len(read_run_log(spark, path).inputFiles()) == 1


def test_full_folders_are_not_merged_again(spark, tmp_path):
    path = str(tmp_path / "log")
    for first in (0, 4):
        for i in range(first, first + 4):
            append_run_log(_log(spark, i), path)
        assert compact_run_log(spark, path, full_bytes=1) == 4
    assert len(list((tmp_path / "log").glob("_merged-*"))) == 2 and _ids(spark, path) == list(range(8))


def test_of_two_merges_one_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for i in range(4):
        append_run_log(_log(spark, i), path)
    create = storage.create_text

    def slower(spark, target, text):
        monkeypatch.setattr(storage, "create_text", create)
        append_run_log(_log(spark, 4), path)
        assert compact_run_log(spark, path) == 5
        create(spark, target, text)

    monkeypatch.setattr(storage, "create_text", slower)
    with pytest.raises(FileExistsError):
        compact_run_log(spark, path)
    assert _ids(spark, path) == list(range(5)) and len(list((tmp_path / "log").glob("_merged-*"))) == 1


def test_readers_beside_appends_and_merges(spark, tmp_path):
    """A reader meets each row once, and none is missing that was there when it began."""
    path = str(tmp_path / "log")
    append_run_log(_log(spark, 0), path)
    done, seen = [1], []

    def read():
        while done[0] < 12:
            least = done[0]
            seen.append((least, _ids(spark, path)))

    with ThreadPoolExecutor(1) as pool:
        reader = pool.submit(read)
        for i in range(1, 12):
            append_run_log(_log(spark, i), path)
            if i % 3 == 0:
                compact_run_log(spark, path)
            done[0] = i + 1
        reader.result()
    assert len(seen) > 3
    for least, ids in seen:
        assert ids == list(range(len(ids))) and len(ids) >= least


def test_an_export_that_cannot_be_put_up_leaves_the_old_one(spark, tmp_path, monkeypatch):
    rows = spark.range(10).selectExpr("id / 10 AS trip_distance", "id AS PULocationID", "id AS DOLocationID", "1.0D AS passenger_count", "id * 2.0D AS prediction")
    root, one = str(tmp_path / "out"), tmp_path / "one"
    write_predictions(rows, f"{root}/query_id=query_x")
    for single in (True, False):
        name = one / str(single)
        export_predictions(spark, root, "query_x", str(name), single_file=single)
        resolve = storage._resolve

        def failing(spark, path):
            location, fs = resolve(spark, path)
            return location, _NoRename(fs) if "part-" in path else fs

        monkeypatch.setattr(storage, "_resolve", failing)
        with pytest.raises(OSError, match="cannot write"):
            export_predictions(spark, root, "query_x", str(name), single_file=single)
        monkeypatch.setattr(storage, "_resolve", resolve)
        assert read_predictions(spark, str(name / "query_x_results.csv")).count() == 10
        assert not list(name.glob("*.old-*"))
    folder = one / "folder" / "query_x_results.csv"
    folder.mkdir(parents=True)
    with pytest.raises(IsADirectoryError):
        export_predictions(spark, root, "query_x", str(one / "folder"))
    assert folder.is_dir()


class _NoRename:
    """A file system that refuses to put up what was written."""

    def __init__(self, fs):
        self._fs = fs

    def __getattr__(self, name):
        return getattr(self._fs, name)

    def rename(self, source, target):
        return "part-" not in source.getName() and self._fs.rename(source, target)


def test_run_log_written_by_other_tools(spark, tmp_path):
    """`True`/`False` as Python writes them."""
    path = _csv(tmp_path, "log.csv", "timestamp,query_id,input,duration_seconds,success,config",
                "2031-05-06 07:08:09,query_1,a.parquet,12.25,True,config_A", "2031-05-06 07:10:11,query_2,b.csv,9.5,False,default")
    assert [r.success for r in read_run_log(spark, path).collect()] == [True, False]


def test_export_one_file_or_parts(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 6).selectExpr(
        "id / 10 AS trip_distance", "id AS PULocationID", "id AS DOLocationID", "1.0D AS passenger_count", "id * 2.0D AS prediction"
    )
    root = str(tmp_path / "out")
    write_predictions(rows, f"{root}/query_id=query_x")
    export_predictions(spark, root, "query_x", str(tmp_path / "one"))
    export_predictions(spark, root, "query_x", str(tmp_path / "many"), single_file=False)
    export_predictions(spark, root, "query_x", str(tmp_path / "one"))
    for target in ("one", "many"):
        exported = read_predictions(spark, str(tmp_path / target / "query_x_results.csv"))
        assert sorted(exported.collect()) == sorted(rows.collect())
    assert [p.name for p in (tmp_path / "one").iterdir() if p.suffix == ".csv"] == ["query_x_results.csv"]
    assert (tmp_path / "one" / "query_x_results.csv").is_file()
    assert len(list((tmp_path / "many" / "query_x_results.csv").glob("part-*.csv"))) > 1
