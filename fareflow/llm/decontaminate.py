"""Benchmark passages in documents, found by spaced seeds.

A seed hashes the words of a window at the positions a fixed mask names and ignores the
others, so a passage with single words replaced still meets it. Documents are read once
for each block of the benchmark; a block has a bounded size, so its index may be sent to
every task, and a benchmark of any size is a matter of more blocks. Copies of one text
are one text there; their items are joined to the hits. No document is shuffled.
Around each hit the two texts are laid over one another and compared word by word.
"""

from collections import defaultdict
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import blocks_for, map_batches, sent, stored, table, text_chunks

# Positions that count (1) in a window of 12 words; weight 8.
MASKS = ("111011010011", "110110101101", "101101110011")
SPAN = len(MASKS[0])

# An overlap counts from so many equal words on (all words of a shorter item, without a
# replacement); a replaced word costs as much as three equal ones bring, so more than three
# quarters of an overlap are equal. Whatever its stretches, an item of MIN_OVERLAP words or
# more counts if WHOLE of all its words, as a fraction, are equal in their places.
# Items of fewer than MIN_ITEM words name nothing.
MIN_OVERLAP = 13
PENALTY = 3
MIN_ITEM = 5
WHOLE = (4, 5)
# Items of so many words at most have runs of four words as seeds too: with a fifth of the words
# replaced a run of four stays, but for one placement in an item of 15 words.
SHORT, RUN = 24, "1111"

# Characters of benchmark text in a block: its index stays under some 100 MB.
BLOCK_CHARS = 4_000_000

HITS = (
    "doc_id long, item_id long, doc_start long, doc_end long, item_start long, item_end long, "
    "matched long, item_words long"
)
_PUNCTUATION = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MULTIPLIERS = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BITS = 20


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split()


def _hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash of the window at each position; there are none if `ids` is shorter."""
    count = len(ids) - len(mask) + 1
    total = np.zeros(max(count, 0), np.uint64)
    if count > 0:
        for at, bit in enumerate(mask):
            if bit == "1":
                total += ids[at : at + count] * _MULTIPLIERS[at]
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """Seeds of one block of items. Items of equal words share an entry."""

    def __init__(self, items: list[tuple[int, str]]):
        same: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
        for item, text in items:
            if len(found := tuple(plain_words(text))) >= MIN_ITEM:
                same[found].append(item)
        self.items = list(same.values())
        vocabulary = sorted({w for found in same for w in found})
        self.vocabulary = {w: k for k, w in enumerate(vocabulary, 1)}
        self.words = [np.array([self.vocabulary[w] for w in found], np.uint64) for found in same]
        self.seeds = {}
        short = {len(w) for w in self.words if len(w) < SPAN}
        for mask in (*MASKS, RUN, *("1" * n for n in sorted(short))):
            fitting = [k for k, w in enumerate(self.words) if (len(w) >= SPAN) == (len(mask) == SPAN) and len(w) >= len(mask)]
            if mask == RUN:
                fitting = [k for k, w in enumerate(self.words) if MIN_OVERLAP <= len(w) <= SHORT]
            elif len(mask) < SPAN:
                fitting = [k for k in fitting if len(self.words[k]) == len(mask)]
            hashed = [_hashes(self.words[k], mask) for k in fitting]
            if not hashed:
                continue
            keys = np.concatenate(hashed)
            order = np.argsort(keys, kind="stable")
            item = np.repeat(np.array(fitting), [len(h) for h in hashed])[order]
            at = np.concatenate([np.arange(len(h)) for h in hashed])[order]
            there = np.zeros(1 << _BITS, bool)
            there[keys >> np.uint64(64 - _BITS)] = True
            self.seeds[mask] = (keys[order], item, at, there)

    def ids(self, text: str) -> np.ndarray:
        found = plain_words(text)
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.uint64, len(found))

    def places(self, ids: np.ndarray, starts: np.ndarray) -> set[tuple[int, int, int]]:
        """(entry, where its first word would lie, text that holds the seed) of every seed that `ids` shares."""
        found = set()
        for mask, (keys, item, at, there) in self.seeds.items():
            hashed = _hashes(ids, mask)
            near = np.flatnonzero(there[hashed >> np.uint64(64 - _BITS)])
            low, high = (np.searchsorted(keys, hashed[near], side) for side in ("left", "right"))
            near, low, count = near[high > low], low[high > low], (high - low)[high > low]
            seed = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            here = np.repeat(near, count)
            text = np.searchsorted(starts, here, "right") - 1
            found.update(zip(item[seed].tolist(), (here - at[seed]).tolist(), text.tolist(), strict=True))
        return found

    def overlap(self, entry: int, ids: np.ndarray, offset: int) -> tuple[int, int, int] | None:
        """(start, end, equal words) in the item of the best stretch with its first word at `offset`."""
        item = self.words[entry]
        low, high = max(0, -offset), min(len(item), len(ids) - offset)
        equal = item[low:high] == ids[low + offset : high + offset]
        sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
        gain = sums - np.minimum.accumulate(sums)
        end = int(np.argmax(gain))
        start = int(np.argmin(sums[: end + 1]))
        matched = int(np.count_nonzero(equal[start:end]))
        if matched >= min(MIN_OVERLAP, len(item)):
            return low + start, low + end, matched
        at = np.flatnonzero(equal)
        if len(item) < MIN_OVERLAP or WHOLE[1] * len(at) < WHOLE[0] * len(item):
            return None
        return low + int(at[0]), low + int(at[-1]) + 1, len(at)


def _hits(index: Index, texts: list[str]) -> list[tuple]:
    """Rows (text's number, item, ...): the best overlap of each text and item."""
    each = [index.ids(t) for t in texts]
    gap = np.zeros(SPAN, np.uint64)
    joined = np.concatenate([x for ids in each for x in (ids, gap)])
    starts = np.cumsum([0, *(len(ids) + SPAN for ids in each)])
    best: dict[tuple[int, int], tuple] = {}
    for entry, place, doc in index.places(joined, starts):
        offset = place - int(starts[doc])
        if (got := index.overlap(entry, each[doc], offset)) is None:
            continue
        start, end, matched = got
        row = (-matched, start + offset, end + offset, start, end)
        if (doc, entry) not in best or row < best[doc, entry]:
            best[doc, entry] = row
    return [
        (doc, item, row[1], row[2], row[3], row[4], -row[0], len(index.words[entry]))
        for (doc, entry), row in sorted(best.items())
        for item in index.items[entry]
    ]


def _search(docs: DataFrame, index: Index) -> DataFrame:
    def work(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
        keys, rows = batch.column(0).to_pylist(), []
        for first, texts in text_chunks(batch.column(1)):
            rows += [(keys[first + doc], *rest) for doc, *rest in _hits(index, texts)]
        columns = list(zip(*rows, strict=True)) or [()] * 8
        names = [field.split()[0] for field in HITS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return map_batches(docs, work, HITS, sent(docs.sparkSession, index))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, where both overlap in words, equal words): the best overlap of each pair.

    Documents and items are compared whole. Null or empty texts overlap nothing; a null
    key stays null; rows that repeat give rows that repeat (items of equal text are
    all named); of several equally good overlaps the first counts. Other columns
    play no part. An empty table on either side gives none.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    items = items.filter(F.length("text") > 0)
    items = stored(items, "benchmark-items")
    texts = items.select("text").distinct().withColumn("entry", F.monotonically_increasing_id())
    texts = stored(texts, "benchmark-texts")
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = blocks_for(chars, BLOCK_CHARS)
    found = []
    for block in range(blocks):
        mine = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        found.append(_search(docs, Index([(r.entry, r.text) for r in mine.toLocalIterator()])))
    named = items.join(texts, "text").select(F.col("entry").alias("of"), F.col("item_id").alias("name"))
    hits = reduce(DataFrame.unionByName, found)
    hits = hits.join(named, hits.item_id == named.of).withColumn("item_id", F.col("name"))
    return hits.select(*[field.split()[0] for field in HITS.split(", ")])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLES: dict[str, str] = {}
