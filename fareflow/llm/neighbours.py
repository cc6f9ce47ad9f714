"""Exact nearest neighbours by a block matrix join on int8 codes.

Vectors are packed into tiles. Each pair of a query tile and a candidate tile is one row
of an equi-join on the two tiles' numbers, so the work spreads over all tasks whatever the
data; a tile's size is a parameter. In a pair, the product of the int8 codes gives every
inner product up to a proven error. Only candidates whose upper bound reaches the k-th
best lower bound are computed again from the vectors, in double precision. The pairs'
short lists are merged by heaps. No candidate that could be among the k nearest is lost.
"""

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import blocks_for, map_batches, stored, table

# Vectors in a tile of candidates and of queries.
TILE = 4096
QUERY_TILE = 1024

TILE_SCHEMA = "tile int, dim int, ids binary, vectors binary, codes binary, bounds binary"
NEAR = "array<struct<down:double,vec_id:long>>"


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 codes, and for each vector (scale, length of scale * code, length of the rest)."""
    scale = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    rest = np.linalg.norm(vectors - near, axis=1)
    return codes, np.stack([scale, np.linalg.norm(near, axis=1), rest])


def _pack(group: pa.Table) -> pa.Table:
    """One tile from the rows of one tile number and dimension."""
    ids = group.column("vec_id").to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    values = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = values.reshape(len(ids), -1)[order]
    exact = vectors.astype(np.float64)
    with np.errstate(over="ignore"):
        good = np.abs(exact).max(axis=1) > 0
    exact, vectors, ids = exact[good], vectors[good], ids[order][good]
    codes, bounds = quantised(exact) if len(ids) else (np.empty(0, np.int8), np.empty(0))
    row = {
        "tile": [group.column("tile")[0].as_py()],
        "dim": [vectors.shape[1]],
        "ids": [ids.tobytes()],
        "vectors": [exact.tobytes()],
        "codes": [codes.tobytes()],
        "bounds": [bounds.tobytes()],
    }
    return pa.table(row, schema=pa.schema([("tile", pa.int32()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "codes", "bounds"))]))


def _tiles(vectors: DataFrame, tiles: int) -> DataFrame:
    """Vectors dealt by a hash of id and vector, so that a tile is about as large as any other."""
    dealt = vectors.withColumn("tile", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(tiles)).cast("int"))
    dealt = dealt.withColumn("dim", F.size("vector"))
    return dealt.groupBy("tile", "dim").applyInArrow(_pack, TILE_SCHEMA)


class _Tile:
    def __init__(self, row: dict, side: str):
        dim = row["dim"]
        self.ids = np.frombuffer(row[f"{side}_ids"], np.int64)
        self.vectors = np.frombuffer(row[f"{side}_vectors"]).reshape(-1, dim)
        self.codes = np.frombuffer(row[f"{side}_codes"], np.int8).reshape(-1, dim)
        self.scale, self.near, self.rest = np.frombuffer(row[f"{side}_bounds"]).reshape(3, -1)


# Products of int8 codes summed over so many dimensions are whole numbers that float32 holds exactly.
_EXACT_DIMS = 2**24 // 127**2
_ROWS = 256


def _nearest(queries: _Tile, others: _Tile, k: int) -> Iterator[tuple[int, list[dict]]]:
    """(query, its k nearest in the tile as (minus score, vec_id), nearest first)."""
    kind = np.float32 if queries.codes.shape[1] <= _EXACT_DIMS else np.float64
    right = others.codes.astype(kind).T
    for low in range(0, len(queries.ids), _ROWS):
        rows = slice(low, low + _ROWS)
        about = (queries.codes[rows].astype(kind) @ right).astype(np.float64)
        about *= queries.scale[rows, None] * others.scale
        error = queries.rest[rows, None] * (others.near + others.rest) + queries.near[rows, None] * others.rest
        error *= 1 + 1e-9
        error += 1e-12 * (queries.near[rows, None] + queries.rest[rows, None]) * (others.near + others.rest)
        own = queries.ids[rows, None] == others.ids
        lower = np.where(own, -np.inf, about - error)
        if lower.shape[1] > k:
            bar = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
        else:
            bar = np.full(len(lower), -np.inf)
        may = (about + error >= bar[:, None]) & ~own
        for at, keep in enumerate(may):
            near = np.flatnonzero(keep)
            # Summed in the order of the components, so the last digit is the same everywhere.
            score = np.add.accumulate(others.vectors[near] * queries.vectors[low + at], axis=1)[:, -1]
            first = np.lexsort((others.ids[near], -score))[:k]
            found = zip((-score[first]).tolist(), others.ids[near[first]].tolist(), strict=True)
            yield int(queries.ids[low + at]), [{"down": d, "vec_id": v} for d, v in found]


_LIST = pa.list_(pa.struct([("down", pa.float64()), ("vec_id", pa.int64())]))


def _merged(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """The k first of each query's ranked lists."""
    rows = []
    for lists in batch.column(1):
        ranked = heapq.merge(*[[(x["down"], x["vec_id"]) for x in part] for part in lists.as_py()])
        rows.append([{"down": d, "vec_id": v} for d, v in islice(ranked, k)])
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _LIST)], names=["query_id", "near"])


def nearest(
    vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", tile: int = TILE, query_tile: int = QUERY_TILE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query, exactly.

    `is_query` is a condition on the key. Queries and candidates are rows with a key
    and a vector that is not null, empty or zero and has only finite components; vectors
    of different lengths don't meet. Rows that repeat both key and vector count once;
    rows of the query's key are its own. Equal scores rank by smaller key. Fewer than k
    candidates are all returned; a query without any has no row. Other columns play no part.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    part = F.col("vec_id").isNotNull() & (F.size("vector") > 0)
    part = part & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    rows = stored(rows.filter(part).distinct(), "vectors")
    asked = rows.filter(is_query(F.col("vec_id")))
    total, queries = rows.count(), asked.count()
    n_tiles, n_query_tiles = blocks_for(total, tile), blocks_for(queries, query_tile)
    columns = ("ids", "vectors", "codes", "bounds")
    left = _tiles(asked, n_query_tiles).select("dim", F.col("tile").alias("q"), *[F.col(c).alias(f"q_{c}") for c in columns])
    right = _tiles(rows, n_tiles).select("dim", F.col("tile").alias("c"), *[F.col(c).alias(f"c_{c}") for c in columns])
    left = left.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    right = right.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_query_tiles - 1))))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                found = list(_nearest(_Tile(row, "q"), _Tile(row, "c"), k))
                if found:
                    ids, near = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(near, _LIST)], names=["query_id", "near"])

    lists = left.join(right, ["q", "c", "dim"]).mapInArrow(products, f"query_id long, near {NEAR}")
    gathered = lists.groupBy("query_id").agg(F.collect_list("near").alias("lists"))
    merged = map_batches(gathered, lambda batch: _merged(batch, k), f"query_id long, near {NEAR}")
    ranked = merged.select("query_id", F.posexplode("near").alias("at", "n"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), (-F.col("n.down")).alias("score")
    )


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


QUERIES = {"op10_neighbours": op10_neighbours}
ORACLES = {
    "op10_neighbours": """
        WITH good AS (
            SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]), lambda a, b: a + b) AS score
            FROM good q JOIN good c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
    """
}
