"""Near-duplicate documents: banded MinHash, Bayesian comparison of signatures, exact links.

Copies with the same set of shingles are one node. Nodes that agree in a band are
candidates. Their signatures are compared batch by batch; after each, a pair goes on only if
the posterior probability that its similarity reaches the threshold is at least the chosen
miss probability (uniform prior: with m of n values equal, the similarity is
Beta(m + 1, n - m + 1), whose upper tail is a binomial sum). What is left is confirmed on
the full sets.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import map_batches, stored, table, text_chunks, words
from fareflow.llm.links import kept_buckets, linked_groups

WORDS = 5
# Least similarity, as a fraction.
SIMILARITY = (75, 100)

# A pair of similarity 0.75 shares no band with probability (1 - 0.75^4)^32, 5 in a million.
BANDS, BAND_VALUES = 32, 4
VALUES = BANDS * BAND_VALUES
# Values compared between two looks at the posterior, and the probability of losing a link there.
LOOK = 32
MISS = 1e-4

_rng = np.random.default_rng(20)
_FLIP = _rng.integers(0, 2**64, VALUES, dtype=np.uint64)
_FACTOR = _rng.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [np.uint64(x | 1) for x in _rng.integers(0, 2**63, WORDS).tolist()]
# Shingles hashed at a time, so that one long text needs no more memory than a short one.
_CHUNK = 2048

# Bits of a bucket's number below its band's.
_BUCKET_BITS = 58

NODE = "doc_id long, digest long, n_shingles long, high long, low long, signature binary"


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's five-word shingles; of all its words if there are fewer."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashed = np.fromiter(map(digest, found), np.uint64, len(found))
    if len(found) < WORDS:
        return np.array([digest(b" ".join(found), seed=len(found))], np.uint64)
    count = len(hashed) - WORDS + 1
    total = np.zeros(count, np.uint64)
    for at in range(WORDS):
        total += hashed[at : at + count]
        total *= _STEP[at]
        total ^= total >> np.uint64(31)
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least of each of VALUES hash functions over the set, as 32 bits."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _CHUNK):
        mixed = (hashes[None, start : start + _CHUNK] ^ _FLIP[:, None]) * _FACTOR[:, None]
        np.minimum(low, mixed.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def least_equal(seen: int, miss: float = MISS) -> int:
    """How many of `seen` values must be equal for the pair to go on."""
    share = SIMILARITY[0] / SIMILARITY[1]
    tail = 0.0
    for equal in range(seen + 1):
        tail += comb(seen + 1, equal) * share**equal * (1 - share) ** (seen + 1 - equal)
        if tail >= miss:
            return equal
    return seen


_LEAST = {seen: least_equal(seen) for seen in range(LOOK, VALUES + 1, LOOK)}


def compare(prints: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signatures outlast every look, and how many of their values are equal."""
    values = np.ascontiguousarray(prints).view(np.uint32)
    equal, near = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    for start in range(0, VALUES, LOOK):
        at = np.flatnonzero(near)
        for low in range(0, len(at), 1 << 14):
            rows = at[low : low + (1 << 14)]
            span = slice(start, start + LOOK)
            equal[rows] += np.count_nonzero(values[i[rows], span] == values[j[rows], span], axis=1)
        near[at] = equal[at] >= _LEAST[start + LOOK]
    return near, equal


def first_shared(bucket: int, prints: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs agree in no band before the bucket's."""
    bands = np.ascontiguousarray(prints).view(np.uint32).reshape(len(prints), BANDS, BAND_VALUES)[:, : bucket >> _BUCKET_BITS]
    mine = np.ones(len(i), bool)
    for low in range(0, len(i), 1 << 14):
        rows = slice(low, low + (1 << 14))
        mine[rows] = ~(bands[i[rows]] == bands[j[rows]]).all(axis=2).any(axis=1)
    return mine


def similar(left: bytes, right: bytes) -> bool:
    """Whether two sets, as sorted hashes, are as similar as asked."""
    a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    least, whole = SIMILARITY
    if whole * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = int(np.count_nonzero(a[np.minimum(a.searchsorted(b), len(a) - 1)] == b))
    return whole * both >= least * (len(a) + len(b) - both)


def all_similar(left: list[bytes], right: list[bytes]) -> np.ndarray:
    return np.fromiter(map(similar, left, right), bool, len(left))


def _low(set_bytes: bytes) -> int:
    digest = xxhash.xxh3_64_intdigest(set_bytes)
    return digest - (digest >> 63 << 64)


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts, high, low, signatures = [], [], [], []
    for _, texts in text_chunks(batch.column(1)):
        for text in texts:
            hashes = shingles(text)
            counts.append(len(hashes))
            high.append(xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=1))
            low.append(_low(hashes.tobytes()))
            signatures.append(signature(hashes).tobytes() if len(hashes) else None)
    wide = [pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(low, pa.int64())]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), *wide, pa.array(signatures, pa.binary())],
        names=["doc_id", "digest", "n_shingles", "high", "low", "signature"],
    )


def _banded(batch: pa.RecordBatch) -> pa.RecordBatch:
    size = batch.num_rows
    flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
    bands = flat.reshape(size, BANDS, BAND_VALUES).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _FACTOR[0], (size, BANDS)).copy()
    for at in range(BAND_VALUES):
        keys ^= bands[:, :, at]
        keys *= _FACTOR[at + 1]
        keys ^= keys >> np.uint64(32)
    keys >>= np.uint64(64 - _BUCKET_BITS)
    keys |= np.arange(BANDS, dtype=np.uint64) << np.uint64(_BUCKET_BITS)
    nodes = np.repeat(batch.column(0).to_numpy(), BANDS)
    return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(nodes)], names=["bucket", "node"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, content) of the texts whose set has the digest in the third column."""
    for batch in batches:
        for first, texts in text_chunks(batch.column(1)):
            sets = [shingles(t).tobytes() for t in texts]
            same = np.array([_low(s) for s in sets]) == batch.column(2).slice(first, len(texts)).to_numpy()
            made = [batch.column(0).slice(first, len(texts)), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["node", "content"]).filter(pa.array(same))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept, text_digest, group) for each row of `docs`.

    A null text, or one without words, has no shingles and is its own component. Rows that
    repeat key and text repeat in the result; texts that share a key are told apart by
    their sets. A row without a key is linked with nothing: component null, kept. Copies are joined by
    their set's digest, so a group of any size costs one node. Other columns play no
    part. The key is a whole number. `text_digest` is the xxhash64 of the text; `group` is null
    for what is linked with nothing by rule, else the same for all of a group and no other.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    docs = docs.withColumn("digest", F.xxhash64("text"))
    signed = stored(map_batches(docs, _signed, NODE), "signed")
    nodes = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # A node is named by its set's digest, for several sets may have the same smallest key.
    where = F.min(F.struct("doc_id", "digest")).alias("where")
    nodes = nodes.groupBy("high", "low").agg(where, F.first("signature").alias("signature")).withColumn("least", F.col("where.doc_id"))
    nodes = stored(nodes.withColumn("node", F.col("low")), "nodes")
    prints = nodes.select("node", F.col("signature").alias("print"))
    buckets = map_batches(nodes.select("node", "signature"), _banded, "bucket long, node long")
    members = kept_buckets(buckets, "near")
    wanted = members.select("node").distinct().join(nodes.select("node", "where.*"), "node")
    # By the text as well: of the texts of one key each is wanted for its own node alone.
    texts = docs.join(wanted, ["doc_id", "digest"]).select("node", "text", F.col("node").alias("low"))
    sets = stored(texts.mapInArrow(_set_batches, "node long, content binary").dropDuplicates(["node"]), "sets")
    groups = linked_groups(members, prints, sets, compare, all_similar, "near", first_shared)
    linked = nodes.select("node", "least").join(groups, "node")
    smallest = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = linked.join(smallest, "component").select("node", "smallest", F.col("component").alias("group"))
    names = [F.coalesce("smallest", "least").alias("component"), F.coalesce("group", "node").alias("group")]
    named = nodes.join(linked, "node", "left").select("high", "low", *names)
    found = signed.select("doc_id", "digest", "n_shingles", "high", "low").join(named, ["high", "low"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    group = F.when(~alone, F.col("group")).alias("group")
    found = found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("digest").alias("text_digest"), group)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return found.select(F.col("doc_id").alias(key), "n_shingles", "component_id", kept, "text_digest", "group")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_digest", "group")


QUERIES = {"op4_near_dedup": op4_near_dedup}
ORACLES = {
    "op4_near_dedup": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ), shingled AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM split
        ), sets AS (
            SELECT doc_id, len(s) AS n, s FROM shingled
        ), parts AS (
            SELECT doc_id, n, unnest(s) AS shingle FROM sets
        ), common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS n
            FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM common WHERE 100 * n >= 75 * (nx + ny - n)
        ), ends AS (
            SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reached AS (
            SELECT doc_id, doc_id AS node FROM sets
            UNION
            SELECT r.doc_id, e.y FROM reached r JOIN ends e ON r.node = e.x
        ), components AS (
            SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
        FROM sets s JOIN components c ON s.doc_id = c.doc_id
    """
}
