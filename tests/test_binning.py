import math
import random

import pytest

from fareflow.operators.binning import CELLS, count_cells, cut, quantile_bins


def frame(spark, columns):
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))


def test_cells_hold_neighbours_and_lose_no_row(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 8) for _ in range(3000)] + [0.0, 0.0, -0.0, 1.0, 2.0, 4.0, 8.0, 0.1, 1e300, 5e-324]
    cells = sorted((r.low, r.high, r.rows) for r in count_cells(frame(spark, {"x": values}), ["x"]).collect())
    assert sum(n for *_, n in cells) == len(values)
    assert all(low <= high for low, high, _ in cells)
    assert all(a[1] < b[0] for a, b in zip(cells, cells[1:]))
    assert all(high - low <= max(abs(low), abs(high)) / CELLS * 2 for low, high, _ in cells if low)


def test_missing_values_are_left_out(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (math.nan,), (math.inf,), (-math.inf,), (2.0,)], "x double")
    assert sorted((r.low, r.rows) for r in count_cells(rows, ["x"]).collect()) == [(1.0, 1), (2.0, 1)]


@pytest.mark.parametrize("parts", [1, 9])
def test_bins_do_not_depend_on_the_layout(spark, parts):
    rng = random.Random(2)
    columns = {"a": [rng.lognormvariate(0, 2) for _ in range(5000)], "b": [float(rng.choice([1, 1, 1, 2, 3, 6])) for _ in range(5000)]}
    columns["hot"] = [7.0] * 4000 + [rng.random() for _ in range(1000)]
    columns["one"] = [3.0] * 5000
    rows = frame(spark, columns)
    stage, n = quantile_bins(rows.repartition(parts), list(columns), 32, "bin_")
    other, _ = quantile_bins(rows.orderBy("a").coalesce(2), list(columns), 32, "bin_")
    assert n == 5000 and stage.getSplitsArray() == other.getSplitsArray()
    binned = stage.transform(rows)
    for column in ("a", "hot"):
        sizes = [r["count"] for r in binned.groupBy(f"bin_{column}").count().collect()]
        assert len(sizes) <= 32 and min(sizes) >= 25
        if column == "a":
            assert max(sizes) < 5000 / 32 * 2
    assert binned.select("b", "bin_b").distinct().count() == binned.select("b").distinct().count() == binned.select("bin_b").distinct().count()
    assert binned.select("bin_one").distinct().count() == 1


def test_cutting():
    assert cut([], 32) == [] and cut([(1.0, 1.0, 9)], 32) == []
    assert cut([(1.0, 1.0, 9), (3.0, 4.0, 1), (9.0, 9.0, 9)], 32) == [2.0, 6.5]
    # A rare value joins its neighbour, also at the end.
    assert cut([(1.0, 1.0, 9000), (3.0, 3.0, 1), (5.0, 5.0, 9000), (8.0, 8.0, 2)], 32) == [2.0]
    many = [(float(k), float(k), 10) for k in range(1000)]
    assert len(cut(many, 32)) <= 31 and cut(many, 32)[0] == 31.5


def test_an_empty_table(spark):
    stage, n = quantile_bins(spark.createDataFrame([], "x double"), ["x"], 32, "bin_")
    assert n == 0 and stage.transform(frame(spark, {"x": [1.0, -5.0]})).count() == 2
