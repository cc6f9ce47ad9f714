"""The prefix trie of conversations, found by blocks of turns.

A turn counts as the digest of its role and text; texts are never shuffled. A prefix is named by
the XOR of 128-bit hashes of its turns, each with its place, so prefixes of all lengths come
from running XORs, which long conversations share out over tasks.

First conversations are grouped by whole blocks of turns: a block's ends are named by the
prefixes before and after it, and equal blocks behind equal prefixes are one. A block without a sibling
is a chain: its turns are nodes with the block's members. Only where blocks part behind one
prefix are they opened, each once, and their turns grouped to find where they part. Sums
over subtrees need no walk: each node belongs to its smallest member, and what a member adds
to a node depends on where its own nodes begin. They are summed over blocks, then opened likewise.

Hot conversations, prefixes and blocks: rows are combined before they are shuffled; joins with one row
a key are left to adaptive execution, which splits their hot side. The one thing that
needs an order over all of a node's members, the digest of their ids, streams through a task.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.llm.common import stored, table

BLOCK = 4
# Blocks that one window takes; longer conversations have several.
SEGMENT = 256

# Of the rebuilt conversations: how many share their head, and the turns it may have.
GROUP, HEADS = 100, 6

EDGE = ("k", "px", "py", "qx", "qy")
NODE = ("depth", "nx", "ny")
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes; a null role or text is empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    spelled = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(spelled.cast("binary"), 256), 1, 32))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): the turns, `pos` counting from 0 in each conversation.

    By turn, null first, then digest; rows without conv_id are left out. Sorted in ranges, so a
    conversation of any length is numbered by many tasks; what a task hands on is a count.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("chars"),
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            lengths = np.diff(np.append(starts, len(ids)))
            at = np.arange(len(ids)) - np.repeat(starts, lengths)
            if last == ids[0]:
                at[: lengths[0]] += held
            last, held = ids[-1], at[-1] + 1
            columns = [*batch.columns, pa.array(np.full(len(ids), part, np.int32)), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "digest", "chars", "part", "at"])

    rows = stored(rows.mapInArrow(run, "conv_id long, digest binary, chars long, part int, at long"), "turns")
    parts = rows.groupBy("part").agg(F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "at")).alias("last"))
    running = F.sum(F.col("last.at") + 1).over(Window.partitionBy("last.conv_id").orderBy("part").rowsBetween(*_UP_TO_HERE))
    parts = parts.select("part", "low", F.col("last.conv_id").alias("high"), running.alias("held"))
    behind = Window.orderBy("part")
    begun = F.when(F.lag("high").over(behind) == F.col("low"), F.lag("held").over(behind))
    parts = parts.select("part", "low", begun.alias("begun")).filter("begun IS NOT NULL")
    pos = F.col("at") + F.when(F.col("conv_id") == F.col("low"), F.col("begun")).otherwise(0)
    return rows.join(parts, "part", "left").select("conv_id", pos.alias("pos"), "digest", "chars")


def with_shared_heads(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) rebuilt: each begins with the first turns of its group's first one.

    Conversation c takes the first h turns of c - c % group (all, if fewer; none, if it is
    absent), then its own after its first h; h = crc32(decimal c) % heads. Of the
    conversations there is one row each, also of those left without a turn.
    """
    turns = stored(turns, "placed")
    key = F.col("conv_id")
    h = (F.crc32(key.cast("string").cast("binary")) % heads).alias("h")
    convs = turns.filter("pos = 0").select("conv_id", (key - key % group).alias("first"), h)
    head = F.array_sort(F.collect_list(F.struct("pos", "digest", "chars")))
    first = turns.filter((key % group == 0) & (F.col("pos") < heads - 1)).groupBy(key.alias("first")).agg(head.alias("head"))
    convs = convs.join(first, "first", "left")
    n_head = F.when(F.col("head").isNull(), 0).otherwise(F.least("h", F.size("head")))
    convs = stored(convs.select("conv_id", "h", "head", n_head.cast("long").alias("n_head")), "convs")
    begun = convs.select("conv_id", "n_head", F.explode("head").alias("t")).select("conv_id", "n_head", "t.*").filter("pos < n_head").drop("n_head")
    own = turns.join(convs.select("conv_id", "h", "n_head"), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"), "digest", "chars")
    return convs.select("conv_id"), stored(begun.unionByName(own), "rebuilt")


def _xor(column: str, over=None) -> Column:
    found = F.bit_xor(column)
    return found if over is None else found.over(over)


def _paths(turns: DataFrame, block: int) -> DataFrame:
    """(conv_id, k, n, px, py, qx, qy, before): every conversation's blocks, the prefixes before and after, and the code points before."""
    rows = turns.withColumn("segment", F.floor(F.col("pos") / (block * SEGMENT))).repartition("conv_id", "segment")
    blocks = rows.groupBy("conv_id", "segment", "k").agg(
        _xor("x").alias("x"), _xor("y").alias("y"), F.count("*").alias("n"), F.sum("chars").alias("chars")
    )
    here = Window.partitionBy("conv_id", "segment").orderBy("k").rowsBetween(*_UP_TO_HERE)
    blocks = stored(
        blocks.select("*", _xor("x", here).alias("rx"), _xor("y", here).alias("ry"), F.sum("chars").over(here).alias("rc")), "blocks"
    )
    totals = blocks.groupBy("conv_id", "segment").agg(_xor("x").alias("x"), _xor("y").alias("y"), F.sum("chars").alias("chars"))
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "conv_id", "segment", _xor("x", earlier).alias("cx"), _xor("y", earlier).alias("cy"), F.sum("chars").over(earlier).alias("cc")
    ).filter("segment > 0")
    rows = blocks.join(carried, ["conv_id", "segment"], "left").fillna(0, ["cx", "cy", "cc"])
    qx, qy = F.col("cx").bitwiseXOR(F.col("rx")), F.col("cy").bitwiseXOR(F.col("ry"))
    before = F.col("cc") + F.col("rc") - F.col("chars")
    rows = rows.select(
        "conv_id", "k", "n", qx.bitwiseXOR(F.col("x")).alias("px"), qy.bitwiseXOR(F.col("y")).alias("py"), qx.alias("qx"), qy.alias("qy"), before.alias("before")
    )
    return stored(rows, "paths")


def _steps(turns: DataFrame, paths: DataFrame) -> DataFrame:
    """The turns of each distinct block, read from its smallest member.

    `parts` tells whether other blocks follow the same prefix; (ux, uy) is the parent, `until` the code points
    of the whole prefix, `chars` those of its last turn.
    """
    edges = paths.groupBy(*EDGE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("before").alias("before"))
    edges = stored(edges, "edges")
    siblings = edges.groupBy("k", "px", "py").agg(F.count("*").alias("n")).filter("n > 1").select("k", "px", "py", F.lit(True).alias("parts"))
    edges = edges.join(siblings, ["k", "px", "py"], "left").fillna(False, ["parts"]).select("conv_id", "k", "px", "py", "n_convs", "before", "parts")
    here = Window.partitionBy("conv_id", "k").orderBy("pos").rowsBetween(*_UP_TO_HERE)
    rows = turns.join(edges, ["conv_id", "k"])
    nx, ny = F.col("px").bitwiseXOR(_xor("x", here)), F.col("py").bitwiseXOR(_xor("y", here))
    rows = rows.select(
        "conv_id", "k", "parts", "n_convs", "chars", "x", "y", (F.col("pos") + 1).alias("depth"), nx.alias("nx"), ny.alias("ny"),
        (F.col("before") + F.sum("chars").over(here)).alias("until"),
    )
    rows = rows.select("*", F.col("nx").bitwiseXOR(F.col("x")).alias("ux"), F.col("ny").bitwiseXOR(F.col("y")).alias("uy"))
    return stored(rows.drop("x", "y"), "steps")


def _members_digest(members: DataFrame) -> DataFrame:
    """(depth, nx, ny, ends_sha256): of the ids of the conversations that end at each node, ascending."""
    rows = members.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    names = [*NODE, "ends_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def made(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in range(3)]
            ids, done = batch.column(3).to_pylist(), []
            new = np.zeros(len(ids), bool)
            new[:1] = True
            for key in keys:
                new[1:] |= key[1:] != key[:-1]
            starts = [*np.flatnonzero(new).tolist(), len(ids)]
            for low, high in zip(starts, starts[1:], strict=False):
                here, spelled = tuple(int(key[low]) for key in keys), ",".join(map(str, ids[low:high])).encode()
                if here == node:
                    digest.update(b"," + spelled)
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = here, hashlib.sha256(spelled)
            if done:
                yield made(done)
        if node is not None:
            yield made([(*node, digest.hexdigest())])

    return rows.mapInArrow(run, "depth long, nx long, ny long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each distinct prefix of the conversations, the root included.

    `convs` has every conv_id once, `turns` (conv_id, pos from 0 without gaps, digest, chars).
    conv_id is the smallest member of the node, depth its turns, parent_conv_id the parent's conv_id (of
    the root null), n_convs its members, n_children its children, n_leaves the childless nodes of its
    subtree, saved_tokens the sum over its subtree of (n_convs - 1) * the code points of the
    last turn, ends_sha256 the digest of the comma-joined ids of those who end there. Conversations alike
    are members of the same nodes; ones without turns are members of the root alone. An
    empty table has no node.
    """
    turns = turns.withColumns({"k": F.floor(F.col("pos") / block), "x": F.xxhash64("pos", "digest"), "y": F.xxhash64("digest", "pos", F.lit(1))})
    paths = _paths(turns, block)
    steps = _steps(turns, paths)
    columns = [*NODE, "ux", "uy", "conv_id", "n_convs", "chars", "until"]
    smallest = [F.min(c).alias(c) for c in ("ux", "uy", "conv_id")]
    parted = steps.filter("parts").groupBy(*NODE).agg(
        *smallest, F.sum("n_convs").alias("n_convs"), F.min("chars").alias("chars"), F.min("until").alias("until")
    )
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.withColumns({**dict.fromkeys((*NODE, "chars", "until"), zero), "ux": none, "uy": none})
    nodes = stored(steps.filter("NOT parts").select(columns).unionByName(parted).unionByName(root), "nodes")

    above = (F.col("depth") - 1).alias("depth")
    kids = nodes.filter("depth > 0").groupBy(above, F.col("ux").alias("nx"), F.col("uy").alias("ny")).agg(F.count("*").alias("n_children"))
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("nx").alias("ux"), F.col("ny").alias("uy"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(kids, [*NODE], "left").fillna(0, ["n_children"])
    nodes = stored(nodes.join(parent, ["depth", "ux", "uy"], "left"), "linked")

    # A conversation's own nodes, where it is the smallest member, are the last ones of its path.
    owners = nodes.groupBy("conv_id").agg(
        F.min(F.col("until") - F.col("chars")).alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    owners = stored(owners, "owners")
    ends = turns.groupBy("conv_id").agg(F.count("*").alias("depth"), _xor("x").alias("nx"), _xor("y").alias("ny"), F.sum("chars").alias("whole"))
    members = convs.join(ends, "conv_id", "left").fillna(0).join(owners, "conv_id", "left")
    members = members.select("conv_id", *NODE, F.coalesce("shared", "whole").alias("shared"), F.coalesce("leaf", zero).alias("leaf"))
    members = stored(members, "members")

    sums = [F.sum("shared").alias("shared"), F.sum("leaf").alias("n_leaves")]
    blocks = paths.join(members.select("conv_id", "shared", "leaf"), "conv_id")
    blocks = blocks.groupBy(*EDGE).agg(F.min("conv_id").alias("conv_id"), *sums).select("conv_id", "k", "shared", "n_leaves")
    opened = stored(steps.select("conv_id", "k", "parts", *NODE).join(blocks, ["conv_id", "k"]), "opened")
    added = ["shared", "n_leaves"]
    summed = opened.filter("NOT parts").select(*NODE, *added)
    summed = summed.unionByName(opened.filter("parts").groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in added]))
    whole = members.agg(*sums).select(*[zero.alias(c) for c in NODE], *added)
    summed = summed.unionByName(whole.filter("shared IS NOT NULL"))

    nodes = nodes.join(summed, [*NODE]).join(_members_digest(members), [*NODE], "left")
    nodes = nodes.join(owners.select("conv_id", F.col("shared").alias("own")), "conv_id")
    saved = F.col("shared") - F.col("own") - (F.col("n_convs") - 1) * (F.col("until") - F.col("chars"))
    nobody = hashlib.sha256(b"").hexdigest()
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of a table (conv_id, turn, role, text) as it is; see `placed_turns` and `prefix_trie`."""
    turns = stored(placed_turns(conversations), "placed")
    return prefix_trie(turns.filter("pos = 0").select("conv_id"), turns, block)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*with_shared_heads(placed_turns(table(spark, sf_dir, "conversations"))))


QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLES = {
    "op12_prefix_trie": """
        WITH crc AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM range(256) AS r(i))
        ), placed AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS first, xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM placed), crc
        ), rebuilt AS (
            SELECT c.conv_id, p.role, p.text, p.pos FROM convs c JOIN placed p ON p.conv_id = c.first AND p.pos <= c.h
            UNION ALL
            SELECT c.conv_id, p.role, p.text, p.pos - c.h + (SELECT count(*) FROM placed f WHERE f.conv_id = c.first AND f.pos <= c.h)
            FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h
        ), paths AS (
            SELECT conv_id, pos AS depth, length(text) AS chars,
                sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos)) AS node
            FROM rebuilt
            UNION ALL SELECT conv_id, 0, 0, '' FROM convs
        ), ends AS (
            SELECT conv_id, max(depth) AS last FROM paths GROUP BY conv_id
        ), nodes AS (
            SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
            FROM paths JOIN ends USING (conv_id) GROUP BY depth, node
        ), above AS (
            SELECT DISTINCT n.depth, n.node, p.node AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
        ), kids AS (
            SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM above GROUP BY ALL
        ), sums AS (
            SELECT p.depth, p.node, CAST(sum((n.n_convs - 1) * n.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (k.n_children IS NULL) AS n_leaves
            FROM nodes n LEFT JOIN kids k USING (depth, node) JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL
        )
        SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s USING (depth, node) LEFT JOIN kids k USING (depth, node)
        LEFT JOIN above a USING (depth, node) LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.node = a.parent
    """
}
