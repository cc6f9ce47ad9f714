"""Helpers that several text operators share."""

import ctypes
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.session import scratch_path

# Bits of a sieve: 8 MB, whatever it is made from.
SIEVE_BITS = 1 << 26
# Fixed value: bits of one bitmap that bitmap_construct_agg makes.
BITMAP = 32_768


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; a null key falls in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


def sent(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcasts `value` with the code of its classes; in a task, the result gives it back."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(shared.value)


def give_back() -> None:
    """Returns freed memory to the system; else a reused worker holds it through the stages that follow."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_batches(df: DataFrame, work: Callable, schema: str, given: Callable[[], Any] | None = None) -> DataFrame:
    """One output batch, or None, from `work` for each Arrow batch of `df`; what was `given` is its second argument."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = [] if given is None else [given()]
        for batch in batches:
            if batch.num_rows and (made := work(batch, *more)) is not None and made.num_rows:
                yield made
        batch = made = None
        more.clear()
        give_back()

    return df.mapInArrow(run, schema)


def marked(rows: DataFrame, columns: Sequence[str], wanted: DataFrame, name: str) -> DataFrame:
    """`rows` and `maybe`: false only where no row of `wanted` agrees in `columns`, nulls being equal.

    What is broadcast is a bitmap of the wanted rows' hashes, of SIEVE_BITS at most. The more
    rows are wanted, the more others are marked too; so a join with `wanted` must follow.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS))
    part, at = F.floor(place / BITMAP).alias("part"), (place % BITMAP).alias("at")
    bitmaps = wanted.select(part, at).repartition("part").groupBy("part").agg(F.expr("bitmap_construct_agg(at)").alias("bitmap"))
    bitmaps = F.broadcast(stored(bitmaps, f"{name}-sieve"))
    joined = rows.withColumns({"part": part, "at": at}).join(bitmaps, "part", "left")
    byte = F.substr("bitmap", (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("at") % 8).cast("int"))
    return joined.withColumn("maybe", F.coalesce(bit == 1, F.lit(False))).drop("part", "at", "bitmap")


def words(text: str | None) -> list[bytes]:
    """Runs other than space and U+0009 to U+000D, A-Z lower-cased: what `bytes` means by both."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b), named by its smallest node.

    Each round sends every node to its smallest neighbour, follows that twice and keeps
    the edges between what remains; at least half of a component's nodes go each round.
    Edges with a null end and loops count for nothing. Rounds are written to the shared
    folder. A node with very many edges is safe: its minimum is taken before the shuffle.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), f"{name}-edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        step = stored(step.select("node", F.least("node", "low").alias("to")), f"{name}-step")
        then = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        step = stored(step.join(then, "to").select("node", F.col("far").alias("to")), f"{name}-jump")
        if labels is None:
            labels = step.withColumnRenamed("to", "component")
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        labels = stored(labels, f"{name}-labels")
        for end in ("a", "b"):
            edges = edges.join(step.select(F.col("node").alias(end), "to"), end).drop(end).withColumnRenamed("to", end)
        edges = stored(edges.filter("a <> b").distinct(), f"{name}-edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def numbered(df: DataFrame, order: Sequence[Column], place: str, name: str) -> DataFrame:
    """The rows of `df` and their `place`, from 1, in the given order over the whole table.

    The table is sorted in ranges and written; what passes between the tasks is one count for
    each range. Rows alike in all of `order` stand in any order.
    """
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Fixed value: such an id is the task's number, then 33 bits for the row's place in the task.
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    rows = stored(rows.withColumns({"_part": part, "_at": at}).drop("_id"), name)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(counts, "_part").withColumn(place, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def merged_components(groups: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """`groups` (node, component) as they are after more edges (a, b), whose ends may be new nodes.

    Only the new edges are contracted, over the names of the groups they join; the groups themselves
    are read once more.
    """
    for end in ("a", "b"):
        named = groups.select(F.col("node").alias(end), "component")
        edges = edges.join(named, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    moved = connected_components(edges, name)
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    renamed = groups.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return stored(renamed.unionByName(moved.join(groups, "node", "left_anti")), f"{name}-groups")


def blocks_for(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def text_chunks(texts: pa.ChunkedArray | pa.Array, chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows, closed once they hold `chars` code points; null is empty."""
    first, held, size = 0, [], 0
    for at, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= chars:
            yield first, held
            first, held, size = at + 1, [], 0
    if held:
        yield first, held
