"""Bin edges of numeric columns that depend on the rows alone, not on how they are dealt.

MLlib takes its split candidates from a sample that it draws by partition. Columns that hold few
values, none of them rare, leave it no choice: every sample shows all of them. So each column is
cut at quantiles of the whole table first. They come from one counting pass with map-side
combine: values are counted in cells of a fixed relative width, and only cells are gathered.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells of each power of two: a cell is at most 1/256 as wide as its values, so a column
# has no more than 256 for each doubling of its range, however many rows there are.
CELLS = 256
# A value with so small a share of the rows may be missed by a sample of MLlib's size, 10,000 rows.
LEAST_SHARE = 0.005


def _cell(value: Column) -> Column:
    """(sign, power, part): cells sort as their values do."""
    size = F.abs(value)
    power = F.when(size > 0, F.floor(F.log2(size)))
    part = F.floor(size / F.pow(F.lit(2.0), power) * CELLS)
    return F.struct(F.signum(value).cast("int").alias("sign"), power.alias("power"), part.alias("part"))


def count_cells(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """(column, low, high, rows): each cell's smallest and largest value and its rows; nulls and NaN are left out."""
    value = F.col("cell.value")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    rows = df.select(cells.alias("cell")).filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(math.inf)))
    rows = rows.select(F.col("cell.column").alias("column"), value.alias("value"), _cell(value).alias("cell"))
    counted = rows.groupBy("column", "cell.sign", "cell.power", "cell.part").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("rows")
    )
    return counted.select("column", "low", "high", "rows")


def cut(cells: list[tuple[float, float, int]], bins: int) -> list[float]:
    """Inner edges of at most `bins` bins, each with its fair share of the rows, or each value's own if they are few.

    A bin holds the values from its lower edge up to, but without, its upper one. Edges lie halfway between
    neighbouring values, so values never seen fall on the nearer side.
    """
    cells = sorted(cells)
    total = sum(rows for _, _, rows in cells)
    least = total * LEAST_SHARE if len(cells) <= bins else total / bins
    edges, held, left = [], 0, total
    for (_, high, rows), (low, _, _) in zip(cells, cells[1:], strict=False):
        held += rows
        left -= rows
        # What is left has to make a bin as well.
        if held >= least and left >= min(least, total * LEAST_SHARE):
            edges.append(high + (low - high) / 2)
            held = 0
    return edges


def quantile_bins(df: DataFrame, columns: list[str] | tuple[str, ...], bins: int, output: str) -> tuple[Bucketizer, int]:
    """(stage, rows): the stage adds `<output><column>`, the number of each column's bin; rows are those of the fullest column.

    An empty table and a column of one value have a single edge that parts nothing.
    """
    cells: dict[str, list[tuple[float, float, int]]] = {c: [] for c in columns}
    for row in count_cells(df, columns).toLocalIterator():
        cells[row.column].append((row.low, row.high, row.rows))
    edges = [cut(cells[c], bins) or [max((high for _, high, _ in cells[c]), default=0.0) + 1.0] for c in columns]
    stage = Bucketizer(
        splitsArray=[[-math.inf, *e, math.inf] for e in edges],
        inputCols=list(columns),
        outputCols=[f"{output}{c}" for c in columns],
    )
    return stage, max((sum(rows for _, _, rows in found) for found in cells.values()), default=0)
