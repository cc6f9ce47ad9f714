"""Connected groups of near-equal nodes, from buckets of candidates, with nothing of quadratic size.

Nodes that share a bucket are candidates. Inside the tasks pairs are compared by small
fingerprints, and those that may be linked exactly, by the nodes' whole contents.

1. Leaders: in each bucket (dealt in blocks of bounded size) a first node is compared with
   all others; those that may be near it are paired with it and set aside; then the next.
   The pairs are confirmed by a join with the contents. Again with one node for each
   group where a bucket has more than a block, until that joins nothing more. A bucket full of copies costs about
   as many comparisons as it has nodes.
2. The rest: where a bucket still holds several groups, all pairs across groups are
   compared, block by block, the largest group's nodes only with the others'. Pairs that
   may be linked are confirmed there, those of many buckets together, the most similar first, unless
   links found before join their groups already; only links that join something leave the task.

So the groups are those of all candidate pairs that pass both comparisons.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import connected_components, give_back, map_batches, merged_components, stored

# Nodes of a block: two of them, with what they hold, are what a task has at a time.
BLOCK = 256

# (fingerprints, pairs as two index arrays) -> which may be linked, and how similar on any scale
Compare = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
# (bucket, fingerprints, pairs as two index arrays) -> which are not candidates in an earlier bucket too
First = Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
# Contents of the two nodes of each pair -> whether they are linked
Exact = Callable[[list[bytes], list[bytes]], np.ndarray]

# Pairs confirmed together; those whose groups were joined by an earlier lot are passed over.
TOGETHER = 512
# Pairs, and bytes of their contents, that a task gathers from its buckets before they are confirmed.
GATHERED, GATHERED_BYTES = 2048, 8_000_000

PAIRS = "a long, b long"


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of each run of rows with equal first `keys` columns, from sorted batches; `print` as a matrix of bytes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = []
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if name == "print":
                size = len(column[0].as_py())
                flat = np.frombuffer(column.buffers()[2], np.uint8, size * len(column), column.offset * size)
                columns.append(flat.reshape(len(column), size))
            else:
                columns.append(column.to_numpy(zero_copy_only=False))
        marks = np.stack(columns[:keys])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            part = [c[low:high] for c in columns]
            if held and any(h[0] != p[0] for h, p in zip(held[-1][:keys], part[:keys], strict=True)):
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            held.append([np.array(p) for p in part] if high == batch.num_rows else part)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _gathered(rows: Iterator[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Pairs with the larger node first, in batches; the last thing a task does."""
    held: list[tuple[int, int]] = []

    def batch() -> pa.RecordBatch:
        ends = np.sort(np.array(held, np.int64), axis=1)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 1]), pa.array(ends[:, 0])], names=["a", "b"])

    for row in rows:
        held.append(row)
        if len(held) == 10_000:
            yield batch()
    if held:
        yield batch()
    give_back()


def _leaders(compare: Compare, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
    for _, _, nodes, prints in _runs(batches, 2):
        left = np.arange(len(nodes))
        while len(left) > 1:
            first, rest = left[0], left[1:]
            near, _ = compare(prints, np.full(len(rest), first), rest)
            yield from ((nodes[first], other) for other in nodes[rest[near]])
            left = rest[~near]


class _Forest:
    """Groups of groups, of those that were joined."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def _across(compare: Compare, first: First | None, exact: Exact, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
    forest = _Forest()
    # By nodes, so that what meets in several buckets is confirmed once: (score, groups, contents).
    held: dict[tuple[int, int], tuple[float, int, int, bytes, bytes]] = {}
    size = 0

    def links() -> Iterator[tuple[int, int]]:
        order = sorted(held.items(), key=lambda pair: -pair[1][0])
        for start in range(0, len(order), TOGETHER):
            lot = [pair for pair in order[start : start + TOGETHER] if forest.root(pair[1][1]) != forest.root(pair[1][2])]
            linked = exact([left for _, (*_, left, _) in lot], [right for _, (*_, right) in lot])
            for (nodes, (_, a, b, _, _)), near in zip(lot, linked, strict=True):
                if near and forest.root(a) != forest.root(b):
                    forest.join(a, b)
                    yield nodes

    for bucket, low, high, block, nodes, groups, prints, contents in _runs(batches, 3):
        left, right = np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])
        i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
        apart = (groups[i] != groups[j]) & ((low[0] != high[0]) | (i < j))
        i, j = i[apart], j[apart]
        if first is not None and len(i):
            mine = first(int(bucket[0]), prints, i, j)
            i, j = i[mine], j[mine]
        near, score = compare(prints, i, j)
        i, j, score = i[near], j[near], score[near]
        for at in np.argsort(-score, kind="stable").tolist():
            x, y = (i[at], j[at]) if nodes[i[at]] < nodes[j[at]] else (j[at], i[at])
            a, b = int(groups[x]), int(groups[y])
            if forest.root(a) != forest.root(b):
                held[int(nodes[x]), int(nodes[y])] = score[at], a, b, contents[x], contents[y]
                size += len(contents[x]) + len(contents[y])
                if len(held) >= GATHERED or size > GATHERED_BYTES:
                    yield from links()
                    held.clear()
                    size = 0
    yield from links()


def _grouped(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    if groups is None:
        return members.withColumn("group", F.col("node"))
    named = groups.select("node", F.col("component").alias("group"))
    return members.join(named, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _divided(members: DataFrame) -> DataFrame:
    """Members of the buckets in which there are several groups."""
    mixed = members.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    return members.join(mixed.filter("low <> high").select("bucket"), "bucket")


def _leader_pairs(members: DataFrame, prints: DataFrame, compare: Compare, above: int) -> DataFrame:
    """One node for each bucket and group, dealt in blocks, where a bucket has more than `above` groups."""
    heads = members.groupBy("bucket", "group").agg(F.min("node").alias("node"))
    sizes = heads.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > above)
    blocks = F.ceil(F.col("n") / BLOCK)
    dealt = heads.join(sizes, "bucket").select("bucket", F.pmod(F.xxhash64("node"), blocks).alias("block"), "node")
    dealt = dealt.join(prints, "node").select("bucket", "block", "node", "print")
    dealt = dealt.repartition("bucket", "block").sortWithinPartitions("bucket", "block", F.xxhash64("node"))
    return dealt.mapInArrow(lambda batches: _gathered(_leaders(compare, batches)), PAIRS).distinct()


def _confirmed(pairs: DataFrame, contents: DataFrame, exact: Exact) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(contents.select(F.col("node").alias(end), F.col("content").alias(f"content_{end}")), end)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        linked = [np.empty(0, bool)]
        for low in range(0, batch.num_rows, 4 * TOGETHER):
            part = batch.slice(low, 4 * TOGETHER)
            linked.append(exact(part.column(2).to_pylist(), part.column(3).to_pylist()))
        return batch.select(["a", "b"]).filter(pa.array(np.concatenate(linked)))

    return map_batches(pairs.select("a", "b", "content_a", "content_b"), work, PAIRS)


def _cross_links(members: DataFrame, prints: DataFrame, contents: DataFrame, compare: Compare, first: First | None, exact: Exact) -> DataFrame:
    """Every bucket's largest group in blocks from 0, the others' nodes in the blocks after; all in one if they are few."""
    counts = members.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("n"))
    of_bucket = counts.groupBy("bucket").agg(
        F.max_by("group", F.struct("n", "group")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("total")
    )
    few = F.col("total") <= BLOCK
    large = F.ceil(F.col("most") / BLOCK)
    small = F.when(few, 0).otherwise(F.ceil((F.col("total") - F.col("most")) / BLOCK))
    main = (few | (F.col("group") == F.col("largest"))).alias("main")
    blocks = (few.alias("few"), large.alias("large"), small.alias("small"))
    rows = members.join(of_bucket, "bucket").select("bucket", "node", "group", main, *blocks)
    digest = F.xxhash64("node")
    block = F.when(F.col("main"), F.pmod(digest, "large")).otherwise(F.col("large") + F.pmod(digest, "small"))
    begin = F.when(F.col("main") & ~F.col("few"), F.col("large")).otherwise(F.lit(0))
    other = F.explode(F.sequence(begin, F.col("large") + F.col("small") - 1))
    rows = rows.withColumn("block", block).join(prints, "node").join(contents, "node").withColumn("other", other)
    ends = (F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    rows = rows.select("bucket", *ends, "block", "node", "group", "print", "content")
    rows = rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    return rows.mapInArrow(lambda batches: _gathered(_across(compare, first, exact, batches)), PAIRS).distinct()


def kept_buckets(buckets: DataFrame, name: str) -> DataFrame:
    """Members (bucket, node) of buckets with two nodes or more; of buckets with the same nodes, one."""
    digests = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *digests).filter("n > 1")
    kept = stored(sizes.groupBy("n", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket"), f"{name}-kept")
    return stored(buckets.join(kept, "bucket").select("bucket", "node"), f"{name}-members")


def linked_groups(
    members: DataFrame,
    prints: DataFrame,
    contents: DataFrame,
    compare: Compare,
    exact: Exact,
    name: str,
    first: First | None = None,
) -> DataFrame:
    """(node, component) of every node with a link.

    `members` (bucket, node) without repeats; `prints` (node, print: bytes of one length);
    `contents` (node, content: bytes) has at least the members.
    """
    groups = None

    def joined(new: DataFrame) -> bool:
        nonlocal groups
        new = stored(new, f"{name}-links")
        if new.isEmpty():
            return False
        groups = connected_components(new, name) if groups is None else merged_components(groups, new, name)
        return True

    above = 1
    while True:
        pairs = stored(_leader_pairs(_grouped(members, groups), prints, compare, above), f"{name}-pairs")
        above = BLOCK
        if not joined(_confirmed(pairs, contents, exact)):
            break
    # A bucket of two has been compared in full.
    large = members.groupBy("bucket").count().filter("count > 2").select("bucket")
    rest = stored(_divided(_grouped(members.join(large, "bucket"), groups)), f"{name}-rest")
    joined(_cross_links(rest, prints, contents, compare, first, exact))
    return groups if groups is not None else members.select("node", F.col("node").alias("component")).limit(0)
