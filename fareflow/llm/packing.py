"""Documents packed into token sequences by the sum-of-squares rule.

Each task packs the documents it reads, so nothing is shuffled and a lost task packs its
own input again to the same sequences. Full sequences of long documents are cut off; the
rest of a document goes to the open window, or a new one, that leaves the least sum over
fill levels of the squared number of windows at that level. The counts stand in one array.
At its end, and when too many windows are open, a task empties its emptiest window; what was
in it is placed by the same rule, and may then be cut where a window is full.
"""

import os
import string
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import give_back, table, text_chunks

SEQUENCE = 2048
END_ID = 1
# Windows a task holds open at most, 8 kB each. It bears on which documents are cut; sequences are as full with any.
MAX_OPEN = 4096
# Words whose ids a task has met of late, and stems inside them, and as many of each of the time before; about 200 bytes each.
CACHED_WORDS = 150_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_ID = 4


# The public byte-level alphabet. Printable bytes are themselves, the others follow U+00FF in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
ALPHABET = [chr(b) if b in _PRINTABLE else chr(256 + _OTHERS.index(b)) for b in range(256)]

# Punctuation that the tokenizer splits from the letters before it: all of ASCII but the apostrophe.
_TRAILING = string.punctuation.replace("'", "")


class WordIds:
    """Token ids of texts as little-endian bytes; those of words are kept as they are met.

    A full table becomes the older one, from which words that come again are taken back, so
    frequent words stay.

    The tokenizer never joins text across a blank. It splits a word of letters from the
    punctuation after it and lower-cases it, so for such words, in the scripts below
    U+0250 and composed, its model is asked for the letters alone; any other goes through all of it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._words = {"": b""}
        self._older: dict[str, bytes] = {}
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._stems: dict[str, bytes] = {}
        self._older_stems: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, stem: str) -> bytes:
        spelled = stem if stem.isascii() else "".join([ALPHABET[b] for b in stem.encode()])
        return self._packed([token.id for token in self._model.tokenize(spelled)])

    def _stem(self, stem: str) -> bytes:
        """Those of the letters inside a word; letters that were met as a word of their own are not kept twice."""
        for met in (self._words, self._stems, self._older):
            if (known := met.get(stem)) is not None:
                return known
        if (known := self._older_stems.get(stem)) is None:
            known = self._plain(stem)
        if len(self._stems) >= CACHED_WORDS:
            self._older_stems, self._stems = self._stems, {}
        self._stems[stem] = known
        return known

    def _new(self, word: str) -> bytes:
        if (ids := self._words.get(word)) is not None:
            return ids
        if (ids := self._older.get(word)) is None:
            ids = self._met(word)
        if len(self._words) >= CACHED_WORDS:
            self._older, self._words = self._words, {"": b""}
        self._words[word] = ids
        return ids

    def _met(self, word: str) -> bytes:
        stem = word.rstrip(_TRAILING)
        low = stem.lower()
        if low.isalpha() and (low.isascii() and stem.isascii() or max(stem) < "\u0250" and is_normalized("NFC", stem)):
            if low == word:
                return self._plain(low)
            ids = self._stem(low)
            if len(stem) < len(word):
                ids += self._new(word[len(stem) :])
        else:
            ids = self._packed(self._tokenizer.encode(word, add_special_tokens=False).ids)
        return ids

    def of(self, text: str) -> bytes:
        blank = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        found = blank.split(" ")
        parts = list(map(self._words.get, found))
        if None in parts:
            parts = [self._new(word) if ids is None else ids for ids, word in zip(parts, found, strict=True)]
        return b"".join(parts)


class Packer:
    """Places pieces (doc, tokens of the doc, start, ids) and yields finished rows."""

    def __init__(self, first_sequence: int, size: int = SEQUENCE):
        self.size = size
        self.levels = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)
        self.count = 0
        self.next = first_sequence

    def add(self, doc: int | None, ids: bytes) -> Iterator[tuple]:
        total, width = len(ids) // _ID, self.size * _ID
        whole = total // self.size
        for k in range(whole):
            yield from self._close([(doc, total, k * self.size, ids[k * width : (k + 1) * width])])
        if total > whole * self.size:
            yield from self._place((doc, total, whole * self.size, ids[whole * width :]))
        if self.count > MAX_OPEN:
            yield from self.empty_one()

    def _place(self, piece: tuple) -> Iterator[tuple]:
        length, n = len(piece[3]) // _ID, self.levels
        change = 2 * (n[length + 1 : self.size] - n[1 : self.size - length]) + 2
        change[n[1 : self.size - length] == 0] = 2 * len(n) * MAX_OPEN
        level, least = 0, 2 * n[length] + 1
        if len(change) and change.min() <= least:
            level = len(change) - int(np.argmin(change[::-1]))
            least = change[level - 1]
        if n[self.size - length] and 1 - 2 * n[self.size - length] <= least:
            level = self.size - length
        window = self._take(level) if level else []
        window.append(piece)
        if level + length == self.size:
            yield from self._close(window)
        else:
            self._put(level + length, window)

    def _take(self, level: int) -> list[tuple]:
        self.levels[level] -= 1
        self.count -= 1
        return self.open[level].pop()

    def _put(self, level: int, window: list[tuple]) -> None:
        self.levels[level] += 1
        self.count += 1
        self.open[level].append(window)

    def empty_one(self) -> Iterator[tuple]:
        """Takes the emptiest window away and places what is in it into the others."""
        for piece in self._take(int(np.flatnonzero(self.levels)[0])):
            yield from self._place_in_open(piece)

    def _place_in_open(self, piece: tuple) -> Iterator[tuple]:
        """As `_place`, but into open windows while there are any; a part that closes one may be cut off for it."""
        doc, total, start, ids = piece
        while ids:
            length, n = len(ids) // _ID, self.levels
            change = np.full(self.size, 2 * self.size * MAX_OPEN)
            change[: self.size - length] = 2 * (n[length : self.size] - n[: self.size - length]) + 2
            change[self.size - length :] = 1 - 2 * n[self.size - length : self.size]
            # No window stands at the level 0.
            change[n[: self.size] == 0] = 2 * self.size * MAX_OPEN
            level = self.size - 1 - int(np.argmin(change[::-1]))
            if not n[level]:
                self._put(length, [(doc, total, start, ids)])
                return
            take = min(self.size - level, length)
            window = self._take(level)
            window.append((doc, total, start, ids[: take * _ID]))
            if level + take == self.size:
                yield from self._close(window)
            else:
                self._put(level + take, window)
            start, ids = start + take, ids[take * _ID :]

    def end(self) -> Iterator[tuple]:
        """Closes everything; the last window is cut into sequences whose lengths are powers of two."""
        while self.count > 1:
            yield from self.empty_one()
        rest = [p for ws in self.open.values() for w in ws for p in w]
        left = sum(len(p[3]) // _ID for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            window, level = [], 0
            while level < size:
                doc, total, start, ids = rest.pop(0)
                take = min(size - level, len(ids) // _ID)
                window.append((doc, total, start, ids[: take * _ID]))
                if take * _ID < len(ids):
                    rest.insert(0, (doc, total, start + take, ids[take * _ID :]))
                level += take
            left -= size
            yield from self._close(window)

    def _close(self, window: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, total, start, ids in window:
            length = len(ids) // _ID
            yield doc, start, length, zlib.crc32(ids), total, self.next, offset
            offset += length
        self.next += 1


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents and their places in sequences of at most 2048 tokens.

    A document is the ids of its whole text and an end id; a null or empty text is the
    end id alone. Every id lies in one piece; all sequences are full but the last
    few of each task, whose lengths are powers of two, so none is padded. Sequence numbers
    are unique, with gaps between tasks. Null and repeated keys and rows stay apart as they
    are; other columns play no part; an empty table gives no piece. The same files
    read in the same splits give the same sequences.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = [pa.int64()] * 7
    names = [field.split()[0] for field in PIECES.split(", ")]
    end = np.array([END_ID], "<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, word_ids, rows = Packer(TaskContext.get().partitionId() << 40), WordIds(tokenizer), []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, texts in text_chunks(batch.column(1)):
                for at, text in enumerate(texts, first):
                    rows += packer.add(keys[at], word_ids.of(text) + end)
                if rows:
                    yield batch_of(rows)
                    rows = []
        rows += packer.end()
        if rows:
            yield batch_of(rows)
        batch = texts = rows = packer = word_ids = None
        give_back()

    return docs.mapInArrow(run, PIECES)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())


QUERIES = {"op6_packing": op6_packing}
ORACLES: dict[str, str] = {}
