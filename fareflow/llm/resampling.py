"""Documents drawn by how much their n-grams look like a target's, with hashed features.

A document's features are its words and pairs of neighbouring words, hashed into buckets by
crc32. The hash is linear: a feature's crc is the XOR of what each byte gives at its distance
from the feature's end, and of a constant of the length. So a table of bytes by distances,
one lookup for each byte and `bitwise_xor.reduceat` over the spans hash a whole batch at once.
Spans longer than the table fold in blocks of its size: the parts of a span are moved past
what follows them by tables for powers of two of bytes.

Counts of both sides are sums over tasks, of one row a bucket at most; the table of gains has
a fixed size and travels to the tasks. The draw is a Gumbel perturbation of each
document's mean gain; ranks come from a sort over ranges, not from one task.
"""

from collections.abc import Iterator
from functools import cache
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import give_back, numbered, stored, table

BUCKETS = 10_000
SEED = 7
SHARE = 25
LEAST_WORDS = 20
# Distances from a span's end that the table holds; 256 kB.
REACH = 256
# Bytes of text whose words are hashed at once.
WINDOW = 1 << 22

_SPACE = 0x20
_U32 = np.uint32


def _word_bytes() -> np.ndarray:
    """True for the bytes of words: digits, a-z and all beyond ASCII."""
    found = np.zeros(256, bool)
    found[0x30:0x3A] = found[0x61:0x7B] = found[0x80:] = True
    return found


WORD = _word_bytes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@cache
def position_table(reach: int = REACH) -> np.ndarray:
    """[distance, byte] -> what the byte adds to a crc when so many bytes follow it."""
    first = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], _U32)
    rows = [first]
    for _ in range(reach - 1):
        rows.append(first[rows[-1] & 255] ^ (rows[-1] >> _U32(8)))
    return np.stack(rows)


@cache
def length_constants(reach: int = REACH) -> np.ndarray:
    """The crc of so many zero bytes, which is what the length alone adds."""
    return np.array([crc32(bytes(n)) for n in range(reach + 1)], _U32)


@cache
def _mover(power: int) -> np.ndarray:
    """[byte of a crc, its value] -> the part of it that remains after 2 ** power zero bytes."""
    if power == 0:
        low = position_table()[0]
        values = np.arange(256, dtype=_U32)
        return np.stack([low, *(values << _U32(8 * (k - 1)) for k in (1, 2, 3))])
    before = _mover(power - 1)
    return _apply(before, before)


def _apply(mover: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return mover[0][crc & 255] ^ mover[1][(crc >> 8) & 255] ^ mover[2][(crc >> 16) & 255] ^ mover[3][crc >> 24]


def moved(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """The linear part `crc` of spans after so many more bytes of zero each."""
    crc, power = crc.copy(), 0
    while (left := zeros >> power).any():
        rows = np.flatnonzero(left & 1)
        crc[rows] = _apply(_mover(power), crc[rows])
        power += 1
    return crc


def constants(lengths: np.ndarray) -> np.ndarray:
    found = length_constants()[np.minimum(lengths, REACH)]
    if len(rows := np.flatnonzero(lengths > REACH)):
        ones = np.full(len(rows), 0xFFFFFFFF, _U32)
        found[rows] = moved(ones, lengths[rows]) ^ ones
    return found


def linear_parts(data: np.ndarray, lengths: np.ndarray, behind: np.ndarray | None = None) -> np.ndarray:
    """The linear part of each span's crc; spans of `lengths` > 0 lie one after another in `data`.

    `behind` counts the bytes that follow a span in its feature; length and count
    then stay within the table. Else a longer span is folded from blocks of the table's size.
    """
    ends = np.cumsum(lengths)
    last = ends - 1 if behind is None else ends - 1 + behind
    distance = np.repeat(last, lengths) - np.arange(len(data))
    starts = ends - lengths
    if behind is not None or len(lengths) == 0 or lengths.max() <= REACH:
        return np.bitwise_xor.reduceat(position_table()[distance, data], starts) if len(lengths) else np.empty(0, _U32)
    contribution = position_table()[distance % REACH, data]
    first = distance % REACH == REACH - 1
    first[starts] = True
    block = np.flatnonzero(first)
    value, place = np.bitwise_xor.reduceat(contribution, block), distance[block] // REACH
    power = REACH.bit_length() - 1
    while len(value) > len(lengths):
        odd = np.flatnonzero(place & 1)
        value[odd + 1] ^= _apply(_mover(power), value[odd])
        even = place & 1 == 0
        value, place = value[even], place[even] >> 1
        power += 1
    return value


def features(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, crc) of every feature of the texts data[offsets[i]:offsets[i + 1]], in windows of words.

    The last word of a window is carried into the next, which may complete its pair.
    """
    at, stop_all = int(offsets[0]), int(offsets[-1])
    kept = (np.empty(0, _U32), np.empty(0, np.int64), np.empty(0, np.int64))
    while at < stop_all:
        stop = min(stop_all, at + window)
        while stop < stop_all and WORD[LOWER[data[stop]]] and WORD[LOWER[data[stop - 1]]]:
            ahead = ~WORD[LOWER[data[stop : stop + window]]]
            stop = stop + int(ahead.argmax()) if ahead.any() else min(stop_all, stop + window)
        block = LOWER[data[at:stop]]
        word = WORD[block]
        cuts = offsets[(offsets > at) & (offsets < stop)] - at
        fresh = np.concatenate([[True], ~word[:-1]])
        fresh[cuts] = True
        starts = np.flatnonzero(word & fresh)
        over = np.concatenate([~word[1:], [True]])
        over[cuts - 1] = True
        ends = np.flatnonzero(word & over) + 1
        rows = np.searchsorted(offsets, starts + at, side="right") - 1
        lengths, bytes_ = ends - starts, block[word]
        own = linear_parts(bytes_, lengths)
        yield rows, own ^ constants(lengths)

        n = len(kept[0])
        own, lengths, rows = (np.concatenate([a, b]) for a, b in zip(kept, (own, lengths, rows), strict=True))
        if len(rows) > 1:
            following = np.append(lengths[1:], 0)
            total = lengths + 1 + following
            pair = np.append(rows[1:] == rows[:-1], False)
            near = pair & (total <= REACH)
            near[:n] = False
            before = np.empty(len(rows), _U32)
            inside = np.repeat(near[n:], lengths[n:])
            before[near] = linear_parts(bytes_[inside], lengths[near], following[near] + 1)
            far = np.flatnonzero(pair & ~near)
            before[far] = moved(own[far], following[far] + 1)
            first = np.flatnonzero(pair)
            space = position_table()[np.minimum(following, REACH - 1), _SPACE]
            beyond = np.flatnonzero(pair & (following >= REACH))
            space[beyond] = moved(np.full(len(beyond), position_table()[0, _SPACE]), following[beyond])
            yield rows[first], before[first] ^ space[first] ^ own[first + 1] ^ constants(total[first])
        kept = (own[-1:], lengths[-1:], rows[-1:])
        at = stop


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and each row's place in them; a null text is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts, repeats counted; buckets without one are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc in features(*_texts(batch.column(0))):
                counts += np.bincount(crc % buckets, minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["bucket", "n"])
        give_back()

    found = texts.select(F.col(text).cast("string")).mapInArrow(run, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln of how much more of the target's features than of the source's are in a bucket), with one added to each."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    pairs = ((source.get(b, 0), target.get(b, 0)) for b in range(buckets))
    return np.array([floor(1000 * log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in pairs], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight) of every row; weight is the floored mean gain, 0 without features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            count, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for rows, crc in features(*_texts(batch.column(1))):
                if len(rows):
                    first = np.flatnonzero(np.diff(rows, prepend=-1))
                    count[rows[first]] += np.diff(np.append(first, len(rows)))
                    total[rows[first]] += np.add.reduceat(gain[crc % len(gain)], first)
            weight = total // np.maximum(count, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(weight)], names=["doc_id", "n_features", "weight"])
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(1000 times a standard Gumbel value) that the key and seed alone decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; `rank` is set for those drawn.

    Words are runs of digits, a-z (A-Z are lowered) and characters beyond ASCII. Of the N documents of
    `least_words` words, the floor(share * N / 100) of highest score are drawn, ties going to
    the smaller key, a null key last. A null text is empty; without a feature the weight is
    0. A null key draws as the empty string would. Repeated rows are documents each, and draw alike. Other columns play no
    part; empty tables are as good as any.
    """
    buckets = [{r.bucket: r.n for r in bucket_counts(side, text).collect()} for side in (docs, target)]
    rows = weighted(docs, gains(*buckets), key, text)
    # Written, as ranges are found from a first look at the rows.
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"))), "weights")
    # A pair fewer than words: n words have 2 n - 1 features.
    able = F.col("n_features") >= 2 * least_words - 1
    rank = [~able, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    rows = numbered(rows, rank, "place", "resampled")
    n = rows.filter(able).count()
    drawn = able & (F.col("place") <= share * n // 100)
    return rows.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
QUERIES = {"op13_resampling": op13_resampling}
ORACLES = {
    "op13_resampling": rf"""
        WITH steps AS (
            SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) AS r(i)
        ), crc AS (
            SELECT list(c ORDER BY i) AS t FROM steps
        ), words AS (
            SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), '{_ALPHABET}', '{_ALPHABET.lower()}'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT 's' AS side, rowid AS id, text FROM (SELECT row_number() OVER () AS rowid, text FROM documents)
                UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark)
        ), occurring AS (
            SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS f FROM words
        ), hashed AS (
            SELECT f, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(f))),
                    lambda k: CAST('0x' || hex(encode(f))[2 * k + 1 : 2 * k + 2] AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT f FROM occurring), crc
        ), counts AS (
            SELECT b AS bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
            FROM (SELECT side, bucket AS b FROM occurring JOIN hashed USING (f)) GROUP BY b
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain
            FROM counts
        ), weights AS (
            SELECT id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM occurring JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY id
        ), scored AS (
            SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE)
                    / 4294967296))) AS BIGINT) AS score
            FROM (SELECT row_number() OVER () AS id, doc_id FROM documents) d LEFT JOIN weights USING (id)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
                count(*) FILTER (n_features >= 39) OVER () AS n
            FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 39 AND place <= 25 * n // 100 THEN place END AS rank
        FROM ranked
    """
}
