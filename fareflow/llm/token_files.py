"""Token ids of a corpus as compressed byte or bit planes, with a chunk index.

The corpus is one run of ids in the order of its keys. Ranges of keys become shards, one
task each; a shard's ids are cut into chunks of a fixed number. A chunk is transposed: plane
k holds the k-th byte (or bit) of all its ids, and each plane is a zstandard frame of its
own. Planes of zeros, as the high bytes of small vocabularies are, take no room.

What is written, by Spark's own writer, so that lost tasks leave nothing behind:

- `chunks`: shard, chunk, first (place in the shard), n_ids, bits (of a plane), planes, the
  documents that end in the chunk (doc_ids, doc_starts, doc_tokens; starts are places in
  the shard) and open_start, the start of the one that goes on in the next chunk.
- `index`: shard, chunk, start (place in the corpus), n_ids and n_docs of every chunk.

Readers take any chunks in any order. A document's crc is put together from its parts.
"""

import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.llm.common import give_back, map_batches, table
from fareflow.llm.packing import ALPHABET
from fareflow.session import scratch_path

END_ID = 2
CHUNK = 32_768
BYTE_PLANES, BIT_PLANES = 8, 1
ZSTD_LEVEL = 1
# Bytes of text that are cut into pieces at once.
WINDOW = 1 << 23
# Pieces whose ids a task keeps, and the longest that it keeps; about 200 bytes each.
CACHED = 800_000
LONGEST_CACHED = 64
# Pieces that go to the tokenizer as one text.
JOINED = 8192

CHUNKS = (
    "shard int, chunk int, first long, n_ids int, bits int, planes array<binary>, open_start long, "
    "doc_ids array<long>, doc_starts array<long>, doc_tokens array<long>"
)
_LONGS = pa.list_(pa.int64())
_CHUNK_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("chunk", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("bits", pa.int32()),
        ("planes", pa.list_(pa.binary())),
        ("open_start", pa.int64()),
        ("doc_ids", _LONGS),
        ("doc_starts", _LONGS),
        ("doc_tokens", _LONGS),
    ]
)


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """zstandard frames of the planes of uint32 ids, the lowest first; a plane of zeros is empty."""
    import zstandard

    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits == BIT_PLANES:
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = rows.T
    pack = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
    return [pack(plane.tobytes()) if plane.any() else b"" for plane in planes]


def from_planes(planes: list[bytes], n_ids: int, bits: int) -> np.ndarray:
    """The ids that `to_planes` was given."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    width = n_ids if bits == BYTE_PLANES else -(-n_ids // 8)
    rows = np.zeros((len(planes), width), np.uint8)
    for row, plane in zip(rows, planes, strict=True):
        if plane:
            row[:] = np.frombuffer(unpack(plane), np.uint8)
    if bits == BIT_PLANES:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n_ids, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


# Kinds of bytes, for the cuts below.
_OTHER, _WORD, _SIGN, _QUOTE, _SPACE, _LINE = range(6)


def _kinds() -> np.ndarray:
    found = np.full(256, _OTHER, np.uint8)
    found[0x21:0x7F] = _SIGN
    for first, last in ("09", "AZ", "az"):
        found[ord(first) : ord(last) + 1] = _WORD
    found[[ord("'"), ord(" "), ord("\n")]] = _QUOTE, _SPACE, _LINE
    return found


KINDS = _kinds()


def visible(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a visible character begins, where one ends, and where a letter or digit ends.

    Beyond ASCII, characters of two bytes from U+00C0 on begin one, as none is white space; letters
    from there to U+024F, all but two signs, end one.
    """
    solid = (kind >= _WORD) & (kind <= _QUOTE)
    letter = np.zeros(len(data), bool)
    before, last = data[:-1], data[1:]
    letter[1:] = (last >= 0x80) & (before >= 0xC3) & (before <= 0xC9)
    # The bytes of U+00D7 and U+00F7, the multiplication and division signs.
    letter[1:] &= (before != 0xC3) | ((last != 0x97) & (last != 0xB7))
    return solid | ((data >= 0xC3) & (data <= 0xDF)), solid | letter, (kind == _WORD) | letter


def cut_places(data: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
    """True where the text may be cut in two without changing any id.

    A byte-level tokenizer first splits a text into runs of letters, digits or signs, each with the space
    before it, and runs of white space less that space. So it always splits before a space that
    something visible follows, before a sign behind a letter or digit, before a line
    end behind something visible, and behind a single line end before something visible. A row begins with a cut.
    """
    kind = KINDS[data]
    begins, ends, letters = visible(data, kind)
    following = np.append(begins[1:], False)
    following[row_starts[row_starts > 0] - 1] = False
    cut = (kind == _SPACE) & following
    cut[1:] |= (kind[1:] == _SIGN) & letters[:-1]
    cut[1:] |= (kind[1:] == _LINE) & ends[:-1]
    cut[2:] |= begins[2:] & (kind[1:-1] == _LINE) & ends[:-2]
    cut[row_starts] = True
    return cut


class PieceIds:
    """Ids of pieces of text; those of short ones are kept as they are met.

    Words of letters alone, which the tokenizer splits no further, go to its model. Other new pieces of a
    space and visible text go to the tokenizer as lines of one text: it always splits off a
    single line end before such a space, as an id of its own. The rest goes one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        pre = self.tokenizer.pre_tokenizer
        known = isinstance(pre, ByteLevel) and not pre.add_prefix_space and pre.use_regex
        # Whether `cut_places` holds for this tokenizer.
        self.cuts = known and self.tokenizer.normalizer is None
        self.model = self.tokenizer.model
        self.between = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1:]
        self.cuts = self.cuts and len(self.between) == 1
        self.whole = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.table: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _encode(self, words: list[str], joined: list[str], alone: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(lengths, ids) of the pieces, kind by kind."""
        ids, at = [], 0
        for word in words:
            spelled = f"{ALPHABET[32]}{word[1:]}" if word[0] == " " else word
            if not word.isascii():
                spelled = "".join([ALPHABET[b] for b in word.encode()])
            ids.append([token.id for token in self.model.tokenize(spelled)])
        lengths = [np.fromiter(map(len, ids), np.int64, len(ids))]
        ids = [np.fromiter(chain.from_iterable(ids), np.uint32)]
        while at < len(joined):
            part = joined[at : at + JOINED]
            found = np.array(self.tokenizer.encode("\n".join([*part, ""]), add_special_tokens=False).ids, np.uint32)
            between = found == self.between
            lengths.append(np.diff(np.flatnonzero(between), prepend=-1) - 1)
            ids.append(found[~between])
            at += JOINED
        for piece in alone:
            found = self.tokenizer.encode(piece, add_special_tokens=False).ids
            lengths.append(np.array([len(found)]))
            ids.append(np.array(found, np.uint32))
        return lengths, ids

    def _is_word(self, piece: str) -> bool:
        word = piece[1:] if piece[0] == " " else piece
        return word.isalpha() and (word.isascii() or max(word) < "\u0250")

    def _joins(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Whether each piece is a space, then what begins and ends visibly, without a line end."""
        if not self.cuts or len(pieces) == 0:
            return np.zeros(len(pieces), bool)
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        kind = KINDS[data]
        begin, end, _ = visible(data, kind)
        found = (kind[ends[:-1]] == _SPACE) & begin[np.minimum(ends[:-1] + 1, len(kind) - 1)] & end[ends[1:] - 1]
        for text in ["\n", *self.whole]:
            found &= ~pc.match_substring(pieces, text).to_numpy(zero_copy_only=False)
        return found

    def codes(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, last + 1) of each piece's ids in the third array; the pieces differ and none is empty."""
        texts = pieces.to_pylist()
        known = np.array(list(map(self.table.get, texts, repeat(-1))), np.int64)
        met = np.flatnonzero(known >= 0)
        if len(texts) - len(met) + len(self.table) > CACHED:
            # Begun anew with those of the pieces at hand.
            self.table = {texts[i]: n for n, i in enumerate(met.tolist())}
            self.ids, self.ends = _gather(self.ids, self.ends, known[met])
            known[met] = np.arange(len(met))
        kinds, joins = ([], [], []), self._joins(pieces).tolist()
        for at in np.flatnonzero(known < 0).tolist():
            kinds[0 if self.cuts and self._is_word(texts[at]) else 1 if joins[at] else 2].append(at)
        places = [at for kind in kinds for at in kind]
        lengths, ids = self._encode(*([texts[at] for at in kind] for kind in kinds))
        all_ids = np.concatenate([self.ids, *ids])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(lengths))])
        known[places] = np.arange(len(self.table), len(self.table) + len(places))
        kept = [at for at in places if len(texts[at]) <= LONGEST_CACHED]
        if len(kept) == len(places):
            self.ids, self.ends = all_ids, ends
        else:
            self.ids, self.ends = _gather(all_ids, ends, np.concatenate([np.arange(len(self.table)), known[kept]]))
        self.table |= zip((texts[at] for at in kept), range(len(self.table), len(self.table) + len(kept)), strict=True)
        return ends[known], ends[known + 1], all_ids


def _gather(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the given entries in that order, and their ends with a zero before."""
    lengths = ends[codes + 1] - ends[codes]
    return ids[ragged(ends[codes], lengths)], np.concatenate([[0], np.cumsum(lengths)])


def ragged(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0] + 1, … (lengths[0] of them), firsts[1], …"""
    ends = np.cumsum(lengths)
    return np.repeat(firsts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def encoded(texts: pa.Array, piece_ids: PieceIds, end_id: int, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, where rows end in them) of consecutive parts of the column; a row's end counts its end id.

    Texts are cut in windows, so a long one is never held as ids as a whole.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    uncut = np.zeros(len(texts), bool)
    for token in piece_ids.whole:
        uncut |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
    if not piece_ids.cuts:
        uncut[:] = True
    end, at, row = np.array([end_id], np.uint32), 0, 0
    while at < len(data) or row < len(texts):
        size = window
        while True:
            stop = min(len(data), at + size)
            starts = offsets[:-1][(offsets[:-1] >= at) & (offsets[:-1] < stop) & (np.diff(offsets) > 0)] - at
            cut = cut_places(data[at:stop], starts)
            for k in np.flatnonzero(uncut & (offsets[:-1] < stop) & (offsets[1:] > at)).tolist():
                cut[max(offsets[k] + 1 - at, 0) : offsets[k + 1] - at] = False
            if stop == len(data):
                last = len(cut)
                break
            # What follows the window's end may forbid or allow a cut in its last two bytes.
            if len(found := np.flatnonzero(cut[1:-2])):
                last = int(found[-1]) + 1
                break
            size *= 2
        begins = np.flatnonzero(cut[:last])
        if len(begins) == 0 or begins[0]:
            begins = np.concatenate([[0], begins]) if last else begins
        stop = at + last
        found = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(np.append(begins, last).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[at:stop]))
        ).dictionary_encode()
        first, past, ids = piece_ids.codes(found.dictionary)
        code = found.indices.to_numpy()
        # Rows that end here: all whose last byte lies before `stop`.
        done = row + int(np.searchsorted(offsets[row + 1 :], stop, side="right")) if stop < len(data) else len(texts)
        after = np.searchsorted(begins + at, offsets[row + 1 : done + 1], side="left")
        firsts = np.insert(first[code], after, len(ids))
        lengths = np.insert((past - first)[code], after, 1)
        row_ends = np.cumsum(lengths)[after + np.arange(len(after))]
        yield np.concatenate([ids, end])[ragged(firsts, lengths)], row_ends
        at, row = stop, done


class Shard:
    """One shard's chunks from consecutive ids."""

    def __init__(self, shard: int, bits: int, size: int):
        self.shard, self.bits, self.size = shard, bits, size
        self.held: list[np.ndarray] = []
        self.n_held = self.first = self.chunk = 0
        self.doc_ids: list[int | None] = []
        self.doc_ends = np.empty(0, np.int64)
        self.doc_start = 0

    def add(self, ids: np.ndarray, doc_ids: list[int | None], row_ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        place = self.first + self.n_held
        self.held.append(ids)
        self.n_held += len(ids)
        self.doc_ids += doc_ids
        self.doc_ends = np.append(self.doc_ends, row_ends + place)
        if self.n_held >= self.size:
            yield self._cut(self.n_held // self.size * self.size)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.n_held:
            yield self._cut(self.n_held)

    def _cut(self, n: int) -> pa.RecordBatch:
        ids = np.concatenate(self.held)
        rows = []
        for low in range(0, n, self.size):
            part = ids[low : min(low + self.size, n)]
            stop = self.first + len(part)
            ended = int(np.searchsorted(self.doc_ends, stop, side="right"))
            ends = self.doc_ends[:ended]
            starts = np.append(self.doc_start, ends)
            self.doc_start = int(starts[-1])
            rows.append(
                {
                    "shard": self.shard,
                    "chunk": self.chunk,
                    "first": self.first,
                    "n_ids": len(part),
                    "bits": self.bits,
                    "planes": to_planes(part, self.bits),
                    "open_start": self.doc_start if self.doc_start < stop else None,
                    "doc_ids": self.doc_ids[:ended],
                    "doc_starts": starts[:-1].tolist(),
                    "doc_tokens": np.diff(starts).tolist(),
                }
            )
            self.doc_ids, self.doc_ends = self.doc_ids[ended:], self.doc_ends[ended:]
            self.first, self.chunk = stop, self.chunk + 1
        self.held, self.n_held = [ids[n:]], len(ids) - n
        return pa.RecordBatch.from_pylist(rows, schema=_CHUNK_ARROW)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    chunk: int = CHUNK,
    bits: int = BYTE_PLANES,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Writes the ids of all texts, each followed by `end_id`, in ascending order of the key.

    A null key comes first; rows of one key are ordered by a hash of their texts; equal rows
    are documents each. A null or empty text is the end id alone. Other columns play no
    part; an empty table has no chunk. No key, however frequent, is bound to one task.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumns({"digest": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("copy")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, piece_ids = Shard(TaskContext.get().partitionId(), bits, chunk), PieceIds(tokenizer)
        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for ids, row_ends in encoded(batch.column(1), piece_ids, end_id):
                yield from shard.add(ids, keys[at : at + len(row_ends)], row_ends)
                at += len(row_ends)
        yield from shard.end()
        batch = keys = ids = shard = piece_ids = None
        give_back()

    # The planes are compressed already.
    rows.mapInArrow(run, CHUNKS).write.option("compression", "none").parquet(f"{path}/chunks")
    chunks = docs.sparkSession.read.parquet(f"{path}/chunks").select("shard", "chunk", "first", "n_ids", F.size("doc_ids").alias("n_docs"))
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    index = chunks.join(totals.select("shard", before.alias("before")), "shard")
    index.select("shard", "chunk", (F.col("before") + F.col("first")).alias("start"), "n_ids", "n_docs").write.parquet(f"{path}/index")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The chunks and `before`, the ids of all shards before theirs."""
    begins = spark.read.parquet(f"{path}/index").filter("chunk = 0").select("shard", F.col("start").alias("before"))
    return spark.read.parquet(f"{path}/chunks").join(begins, "shard")


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(start, ids) of the chunks that meet places start to stop - 1 of the corpus, cut to them.

    The index says which chunks; other row groups are not read.
    """
    index = spark.read.parquet(f"{path}/index").filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    shards = index.agg(F.min("shard").alias("low"), F.max("shard").alias("high")).first()
    rows = _placed(spark, path).filter(F.col("shard").between(shards.low, shards.high))
    rows = rows.withColumn("start", F.col("before") + F.col("first")).select("start", "n_ids", "bits", "planes")
    rows = rows.filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        firsts, parts = [], []
        for row in batch.to_pylist():
            ids = from_planes(row["planes"], row["n_ids"], row["bits"])
            low, high = max(start - row["start"], 0), min(stop - row["start"], len(ids))
            firsts.append(row["start"] + low)
            parts.append(ids[low:high].tolist())
        return pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(parts, _LONGS)], names=["start", "ids"])

    return map_batches(rows, work, "start long, ids array<long>")


_PARTS = "doc_start long, place long, n long, crc long, doc_id long, doc_tokens long"


def _parts(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """One row for each document and chunk that holds some of it; its last part names it."""
    rows = []
    for at in range(batch.num_rows):
        chunk = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
        ids = from_planes(chunk["planes"], chunk["n_ids"], chunk["bits"]).tobytes()
        first, before = chunk["first"], chunk["before"]
        docs = list(zip(chunk["doc_starts"], chunk["doc_tokens"], chunk["doc_ids"], strict=True))
        if chunk["open_start"] is not None:
            docs.append((chunk["open_start"], None, None))
        for start, tokens, doc_id in docs:
            low, high = max(start - first, 0), chunk["n_ids"] if tokens is None else start + tokens - first
            rows.append((before + start, before + first + low, high - low, zlib.crc32(ids[4 * low : 4 * high]), doc_id, tokens))
    names = [field.split()[0] for field in _PARTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names) if rows else None


def crc_joined(parts: list[tuple[int, int, int]]) -> int:
    """crc32 of (place, ids, crc32) put together in order of place."""
    whole = 0
    for _, n, crc in sorted(parts):
        zeros = bytes(4 * n)
        whole = zlib.crc32(zeros, whole) ^ zlib.crc32(zeros) ^ crc
    return whole


def _joined(batch: pa.RecordBatch) -> pa.RecordBatch:
    crc = [
        parts[0]["crc"] if len(parts) == 1 else crc_joined([(p["place"], p["n"], p["crc"]) for p in parts]) for parts in batch.column("parts").to_pylist()
    ]
    kept = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
    return pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    parts = map_batches(_placed(spark, path).drop("shard", "chunk"), _parts, _PARTS)
    docs = parts.groupBy(F.col("doc_start").alias("start")).agg(
        F.max("doc_id").alias("doc_id"),
        F.max("doc_tokens").alias("n_tokens"),
        F.collect_list(F.struct("place", "n", "crc")).alias("parts"),
    )
    return map_batches(docs, _joined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizer())
    return read_documents(spark, path)


QUERIES = {"op11_token_files": op11_token_files}
# A tokenizer has no SQL; the tests hold it against a plain version.
ORACLES: dict[str, str] = {}
