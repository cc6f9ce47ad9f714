"""The jobs as a user calls them, one after the other on one folder."""

import json
import re

import pytest
from pyspark.sql import functions as F

from fareflow.__main__ import main

HEADER = "trip_distance,PULocationID,DOLocationID,passenger_count,tpep_pickup_datetime"


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("home")
    for month in (1, 2, 11):
        trips = spark.range(400).select(
            F.expr(f"timestamp_ntz'2022-{month:02d}-03 00:00:00' + make_interval(0, 0, 0, 0, id % 24)").alias("tpep_pickup_datetime"),
            (F.col("id") % 50 / 5 + 0.1).alias("trip_distance"),
            F.lit(1).cast("bigint" if month < 3 else "double").alias("passenger_count"),
            (F.col("id") % 50 / 2 + 3).alias("fare_amount"),
            (F.col("id") % 263).alias("PULocationID"),
            (F.col("id") % 100).alias("DOLocationID"),
        )
        trips.write.parquet(str(home / "raw" / f"yellow_tripdata_2022-{month:02d}.parquet"))
    (home / "t.csv").write_text("\n".join([HEADER, "3.7,41,66,1,2022-03-08 06:20:00", "6.4,12,88,2,2022-03-08 21:10:00"]) + "\n")
    (home / "bad.csv").write_text("\n".join([HEADER, "0,41,66,1,2022-03-08 06:20:00"]) + "\n")
    return home


def test_a_whole_session(home, capsys):
    at = {name: str(home / name) for name in ("raw", "cleaned", "model", "record", "t.csv", "bad.csv", "out", "log", "analysis", "mine")}
    main(["preprocess", "--raw", at["raw"], "--years", "2020-2023", "--out", at["cleaned"], "--by-month"])
    main(["train", "--cleaned", at["cleaned"], "--years", "2022", "--model", at["model"], "--rounds", "3"])
    assert "test_records" in capsys.readouterr().out
    main(["evaluate", "--model", at["model"], "--cleaned", at["cleaned"], "--record", at["record"]])
    (part,) = (home / "record").glob("part-*.json")
    assert json.loads(part.read_text())["test_records"] > 100

    main(["submit", "--model", at["model"], "--input", at["t.csv"], "--results", at["out"], "--log", at["log"], "--config-label", "config_A"])
    name = re.search(r"query_\S+", capsys.readouterr().out).group()
    with pytest.raises(SystemExit):
        main(["submit", "--model", at["model"], "--input", at["bad.csv"], "--results", at["out"], "--log", at["log"]])
    capsys.readouterr()
    main(["results", "--results", at["out"], "--log", at["log"], "--list"])
    listed = capsys.readouterr().out.split("\n")
    assert f"{name:<50} complete" in listed and sum("no results" in line for line in listed) == 1

    main(["results", "--results", at["out"], "--list"])
    assert capsys.readouterr().out.split() == [name, "complete"]

    main(["results", "--results", at["out"], "--query", name, "--download", at["mine"]])
    shown = capsys.readouterr().out.splitlines()
    assert len(shown) == 3 and shown[0].startswith("  distance  pickup zone")
    assert shown[1].split()[:4] == ["3.7", "41", "66", "1.0"]
    assert len((home / "mine" / f"{name}_results.csv").read_text().splitlines()) == 3

    main(["analyse", "--log", at["log"], "--record", at["analysis"]])
    assert "best_config: config_A" in capsys.readouterr().out
    main(["predict", "--model", at["model"], "--input", at["t.csv"], "--output", str(home / "single")])
    assert "scored 2 trips" in capsys.readouterr().out
    main(["submit", "--model", at["model"], "--input", str(home / "t*.csv"), "--results", str(home / "out2"), "--log", str(home / "log2")])
    assert "t.csv  complete" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["submit", "--model", at["model"], "--input", str(home / "none*.csv"), "--results", str(home / "out2"), "--log", str(home / "log2")])
    assert list((home / "single").glob("part-*.csv"))


def test_train_from_raw_and_intake(home, capsys):
    main(["train", "--raw", str(home / "raw"), "--model", str(home / "model2"), "--rounds", "2", "--partitions", "2"])
    (home / "landing").mkdir()
    (home / "landing" / "a.csv").write_text((home / "t.csv").read_text())
    schema = ", ".join(f"{c} string" for c in HEADER.split(","))
    main(["intake", "--model", str(home / "model2"), "--landing", str(home / "landing"), "--schema", schema, "--format", "csv",
          "--results", str(home / "streamed"), "--checkpoint", str(home / "cp")])
    assert len(list((home / "streamed").glob("query_id=*"))) == 1


@pytest.mark.parametrize("argv", [
    ["results", "--results", "/none"],
    ["results", "--results", "/none", "--query", "query_x"],
    ["train", "--model", "/none"],
    ["preprocess", "--raw", "/none", "--out", "/none/out"],
    ["no-such-job"],
])
def test_errors_end_the_process(spark, argv):
    with pytest.raises(SystemExit) as stopped:
        main(argv)
    assert stopped.value.code not in (0, None)
