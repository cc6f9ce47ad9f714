"""Language-model scores of texts by a hashed maximum-entropy model.

The probability of a word is that of its class, given the words before it, times that of
its member of the class, given those words and the class, times that of the word in its
member. All of it comes from the words themselves: the most frequent words are classes of
their own, the others share one by their last two bytes; in a class the most frequent
words are members of their own, the others share one by their first two bytes. The first
two factors are softmaxes whose features (the last word, the one before, pairs of their
classes, skips; in a class, each of them with the class) are hashed into rows of weight
matrices of fixed size. Tasks descend gradients on their own documents; their matrices are
summed as a tree, averaged and sent out again. In a shared member, words stand by their counts.

Counts and descent are over all training documents. A list of the most frequent words, of bounded
length, goes to every task; the others' counts are joined by word.
"""

from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import blocks_for, fold, map_batches, sent, stored, table, text_chunks, words

# No word has a blank in it.
END = b" "

CLASSES = 64
# Words with a class of their own, of which the text's end is one.
OWN = 16
# Members of a class, of which the first so many are single words.
MEMBERS, NAMED = 32, 16
# Rows of hashed features in each weight matrix, a power of two up to 32,768: 4 and 2 MB.
ROWS = 1 << 14
FEATURES, INNER = 6, 4
# The most frequent words, whose counts every task has; some 15 MB there.
FREQUENT = 100_000

# Rounds in which every training document is descended on.
PASSES = 1
DOCS_PER_TASK = 10_000
RATE = 0.2
# What the squares of a row begin with, so that rows met seldom take small steps.
FIRST_SQUARE = 1.0
LIMIT = 60.0
# A row met more often in a batch is summed on its own beyond so many times.
SINGLY = 24
BATCH = 4096
# Rows of a matrix that are summed together, and how many tasks' sums meet at a time.
_SLAB, _FAN = 512, 16
_SALT = (np.arange(1, FEATURES + INNER + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def class_of(word: bytes, own: dict[bytes, int]) -> int:
    """Class by the word alone, in 0 to CLASSES - 1."""
    if (known := own.get(word)) is not None:
        return known
    return OWN + xxhash.xxh3_64_intdigest(word[-2:]) % (CLASSES - OWN)


def cell_of(word: bytes, own: dict[bytes, int], named: dict[bytes, int]) -> int:
    """Class and member, by the word alone, as one number."""
    kind = class_of(word, own)
    if kind < OWN:
        return kind * MEMBERS
    member = named.get(word)
    return kind * MEMBERS + (NAMED + xxhash.xxh3_64_intdigest(word[:2]) % (MEMBERS - NAMED) if member is None else member)


class Vocabulary:
    """The frequent words' numbers, hashes, cells and counts, most frequent first."""

    def __init__(self, frequent: list[tuple[bytes, int]], total: int, distinct: int):
        words = [w for w, _ in frequent if w != END]
        self.own = {w: k for k, w in enumerate([END, *words[: OWN - 1]])}
        self.named: dict[bytes, int] = {}
        found = np.zeros(CLASSES, np.int64)
        for word in words[OWN - 1 :]:
            kind = class_of(word, self.own)
            if found[kind] < NAMED:
                self.named[word] = int(found[kind])
                found[kind] += 1
        self.frequent = [w for w, _ in frequent]
        self.hash = np.array([xxhash.xxh3_64_intdigest(w) for w, _ in frequent], np.uint64)
        self.cell = np.array([cell_of(w, self.own, self.named) for w, _ in frequent], np.int64)
        self.count = np.array([c for _, c in frequent], np.float64)
        self.total, self.distinct = total, distinct
        self.cell_total = np.zeros(CLASSES * MEMBERS)
        self.cell_distinct = np.zeros(CLASSES * MEMBERS)
        self._by_end: dict[bytes, int] = {}
        self._by_start: dict[bytes, int] = {}

    def cell_of(self, word: bytes) -> int:
        """That of a word that is not frequent; there are 65,792 ends and starts of words at most."""
        end, start = word[-2:], word[:2]
        if (kind := self._by_end.get(end)) is None:
            kind = self._by_end[end] = OWN + xxhash.xxh3_64_intdigest(end) % (CLASSES - OWN)
        if (member := self._by_start.get(start)) is None:
            member = self._by_start[start] = NAMED + xxhash.xxh3_64_intdigest(start) % (MEMBERS - NAMED)
        return kind * MEMBERS + member

    def room(self) -> np.ndarray:
        """What the counts of a member's words, and one for each, add up to, with one for all words not seen."""
        return self.cell_total + self.cell_distinct + 1

    def starting_weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the two matrices: at first only the features that every token has weigh, the classes' and members' shares."""
        outer = np.zeros((ROWS, CLASSES), np.float32)
        by_class = self.cell_total.reshape(CLASSES, MEMBERS).sum(axis=1)
        outer[Tokens(self, [[END]]).features()[0, 0]] = np.log((by_class + 1) / (self.total + CLASSES))
        inner = np.zeros((ROWS + CLASSES, MEMBERS), np.float32)
        share = self.room().reshape(CLASSES, MEMBERS)
        # Nothing unseen is in a member for a single word; one that no word has is all but ruled out.
        share[:, :NAMED] -= 1
        share = np.log(np.maximum(share, 1e-9))
        inner[ROWS:] = share - share.max(axis=1, keepdims=True)
        return outer, inner

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + 1 * (self.distinct + 1)))

    def inside(self, count: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """log10 probability of words in their members; a shared one keeps one count for all words not seen."""
        single = (cell < OWN * MEMBERS) | (cell % MEMBERS < NAMED)
        return np.where(single, 0.0, np.log10((count + 1) / self.room()[cell]))

    @cached_property
    def listed(self) -> pa.Array:
        """The frequent words in the order of their numbers; a text's end is empty, as no word is."""
        return pa.array([b"" if w == END else w for w in self.frequent], pa.binary())

    def read(self, texts: list[str]) -> "Tokens":
        """Words as `words` has them. A blank added to a text leaves an empty piece behind it, which is its end."""
        blank = pa.array([t.encode("utf-8", "surrogatepass") + b" " for t in texts], pa.binary()).view(pa.string())
        found = pc.ascii_split_whitespace(pc.ascii_lower(blank))
        pieces, ends = found.flatten().view(pa.binary()), found.offsets.to_numpy()
        # Blanks before a text leave an empty piece too.
        real = pc.binary_length(pieces).to_numpy() > 0
        real[ends[1:] - 1] = True
        if not real.all():
            pieces, ends = pieces.filter(pa.array(real)), np.append(0, np.cumsum(np.add.reduceat(real, ends[:-1], dtype=np.int32)))
        return Tokens(self, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces))


class Tokens:
    """The tokens of several texts end to end."""

    def __init__(self, vocabulary: Vocabulary, found: list[list[bytes]] | pa.ListArray):
        if isinstance(found, list):
            found = pa.array([[b"" if w == END else w for w in tokens] for tokens in found], pa.list_(pa.binary()))
        flat = found.flatten()
        self.sizes = np.diff(found.offsets.to_numpy()).astype(np.int64)
        self.number = pc.fill_null(pc.index_in(flat, value_set=vocabulary.listed), -1).to_numpy().astype(np.int64)
        self.rare = np.flatnonzero(self.number < 0)
        self.rare_words = [w or END for w in flat.take(pa.array(self.rare)).to_pylist()]
        if len(vocabulary.hash):
            self.hash, self.cell = vocabulary.hash[self.number], vocabulary.cell[self.number]
        else:
            self.hash, self.cell = np.zeros(len(flat), np.uint64), np.zeros(len(flat), np.int64)
        self.hash[self.rare] = np.fromiter(map(xxhash.xxh3_64_intdigest, self.rare_words), np.uint64, len(self.rare))
        self.cell[self.rare] = [vocabulary.cell_of(w) for w in self.rare_words]
        self.kind, self.member = np.divmod(self.cell, MEMBERS)
        self.starts = np.cumsum(self.sizes) - self.sizes

    @cached_property
    def before(self) -> tuple[np.ndarray, ...]:
        """The last two words' hashes and the last three's classes of each token; before a text there are ends."""
        starts = [self.starts + k for k in range(3)]

        def back(values: np.ndarray, steps: int, filler) -> np.ndarray:
            moved = np.empty_like(values)
            moved[:steps] = filler
            moved[steps:] = values[:-steps]
            for k in range(steps):
                moved[starts[k][self.sizes > k]] = filler
            return moved

        end = np.uint64(xxhash.xxh3_64_intdigest(END))
        kinds = self.kind.astype(np.uint64)
        return *(back(self.hash, k, end) for k in (1, 2)), *(back(kinds, k, np.uint64(0)) for k in (1, 2, 3))

    def features(self) -> np.ndarray:
        """(FEATURES, tokens) rows of the classes' weight matrix."""
        last, before, k1, k2, k3 = self.before
        many = np.uint64(CLASSES)
        return _rows((np.zeros_like(last), last, before, k1 * many + k2, k2 * many + k3, last * np.uint64(31) + k2), _SALT)

    def inner(self) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens' classes have several members, and the (INNER, those) rows of the members' weight matrix."""
        at = np.flatnonzero(self.kind >= OWN)
        last, before, k1, k2, _ = (x[at] for x in self.before)
        kind = self.kind[at].astype(np.uint64)
        rows = _rows((kind, last + kind, before + kind, (k1 * np.uint64(CLASSES) + k2) * np.uint64(CLASSES) + kind), _SALT[FEATURES:])
        rows[0] = ROWS + self.kind[at]
        return at, rows


def _rows(values: tuple[np.ndarray, ...], salts: np.ndarray) -> np.ndarray:
    rows = np.empty((len(values), len(values[0])), np.int64)
    for row, value, salt in zip(rows, values, salts, strict=False):
        value = (value ^ salt) * salt
        value ^= value >> np.uint64(31)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        row[:] = value >> np.uint64(65 - ROWS.bit_length())
    return rows


def _sums(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, columns) sums of weights, held within LIMIT so that no exponential overflows, and as much room."""
    scores = np.take(weights, rows[0], axis=0, mode="clip")
    part = np.empty_like(scores)
    for row in rows[1:]:
        np.take(weights, row, axis=0, out=part, mode="clip")
        scores += part
    np.clip(scores, -LIMIT, LIMIT, out=scores)
    return scores, part


def log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(tokens, columns) log probabilities."""
    scores, part = _sums(weights, rows)
    np.exp(scores, out=part)
    scores -= np.log(part.sum(axis=1))[:, None]
    return scores


def log_softmax_at(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """(tokens) log probabilities, each of one column."""
    scores, part = _sums(weights, rows)
    np.exp(scores, out=part)
    return scores[np.arange(len(columns)), columns] - np.log(part.sum(axis=1))


class Trainer:
    """Adaptive gradient descent from given weights, on one task's documents; a row of weights has one step size."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.copy()
        self.squares = np.full(len(weights), FIRST_SQUARE, np.float32)
        self.seen = np.zeros(len(weights))

    def learn(self, rows: np.ndarray, kinds: np.ndarray) -> None:
        for low in range(0, rows.shape[1], BATCH):
            self.update(rows[:, low : low + BATCH], kinds[low : low + BATCH])

    def update(self, rows: np.ndarray, kinds: np.ndarray) -> None:
        slope = log_softmax(self.weights, rows)
        np.exp(slope, out=slope)
        slope[np.arange(len(kinds)), kinds] -= 1
        flat = rows.ravel().astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        starts = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)
        count = np.diff(starts, append=len(ordered))
        # The rows met most often come first, so that those met k times or more are a prefix, up to SINGLY times.
        few = np.minimum(count, SINGLY).astype(np.uint8)
        often = np.argsort(SINGLY - few, kind="stable")
        starts, count, few = starts[often], count[often], few[often].astype(np.int64)
        which, order = ordered[starts], np.tile(np.arange(len(kinds)), len(rows))[order]
        total = np.take(slope, order[starts], axis=0, mode="clip")
        for k, rest in enumerate(np.searchsorted(-few, -np.arange(2, few[0] + 1), "right"), 1):
            total[:rest] += np.take(slope, order[starts[:rest] + k], axis=0, mode="clip")
        for row in np.flatnonzero(count > SINGLY):
            total[row] += np.take(slope, order[starts[row] + SINGLY : starts[row] + count[row]], axis=0, mode="clip").sum(axis=0)
        squares = self.squares[which] + np.einsum("ij,ij->i", total, total) / (count * total.shape[1]).astype(np.float32)
        self.squares[which] = squares
        total *= (RATE / np.sqrt(squares * count))[:, None].astype(np.float32)
        self.weights[which] = np.subtract(np.take(self.weights, which, axis=0, mode="clip"), total, out=total)
        self.seen[which] += count

    def slabs(self) -> Iterator[tuple[int, bytes]]:
        """Weights times how often a row was seen, and that, in slabs of rows."""
        both = np.concatenate([self.weights * self.seen[:, None], self.seen[:, None]], axis=1)
        for low in range(0, len(both), _SLAB):
            if both[low : low + _SLAB, -1].any():
                yield low // _SLAB, both[low : low + _SLAB].tobytes()


def _counted(docs: DataFrame) -> DataFrame:
    """(word, count) over all tokens of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "count"])
            counts.clear()
            return made

        for batch in batches:
            for _, texts in text_chunks(batch.column(1)):
                for text in texts:
                    counts.update(words(text))
                counts[END] += len(texts)
                if len(counts) > 400_000:
                    yield flush()
        if counts:
            yield flush()

    return docs.mapInArrow(run, "word binary, count long").groupBy("word").agg(F.sum("count").alias("count"))


def _cell_sums(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    own, named, cells = vocabulary.own, vocabulary.named, CLASSES * MEMBERS

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([cell_of(w, own, named) for w in batch.column(0).to_pylist()])
        distinct = np.bincount(found, minlength=cells)
        met = np.flatnonzero(distinct)
        total = np.bincount(found, batch.column(1).to_numpy(), cells).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met]), pa.array(distinct[met])], names=["cell", "total", "n"])

    return map_batches(counts, work, "cell long, total long, n long").groupBy("cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(len(group.column("slab")[0].as_py()) // 8)
    for slab in group.column("slab"):
        total += np.frombuffer(slab.as_buffer(), np.float64)
    return pa.table({c: group.column(c)[:1] for c in ("factor", "block", "slot")} | {"slab": [total.tobytes()]})


def _tasks(docs: DataFrame) -> tuple[DataFrame, int]:
    """`docs` in fewer tasks, each of as many splits, of about DOCS_PER_TASK documents; and how many tasks at most."""
    splits = docs.rdd.getNumPartitions()
    wanted = blocks_for(docs.count(), DOCS_PER_TASK) + 5
    tasks = blocks_for(splits, max(1, splits // wanted))
    return docs.coalesce(tasks), tasks


def _trained(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The classes' and the members' weights after PASSES rounds of descent in tasks and averaging."""
    weights = vocabulary.starting_weights()
    docs, tasks = _tasks(docs)
    schema = "factor long, block long, slot long, slab binary"
    for _ in range(PASSES):
        given = sent(docs.sparkSession, (vocabulary, weights))

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            known, start = given()
            outer, inner = (Trainer(w) for w in start)
            for batch in batches:
                for _, texts in text_chunks(batch.column(1)):
                    tokens = known.read(texts)
                    outer.learn(tokens.features(), tokens.kind)
                    at, rows = tokens.inner()
                    inner.learn(rows, tokens.member[at])
            slot = TaskContext.get().partitionId()
            for factor, trainer in enumerate((outer, inner)):
                for block, slab in trainer.slabs():
                    row = [pa.array([x]) for x in (factor, block, slot)]
                    yield pa.RecordBatch.from_arrays([*row, pa.array([slab], pa.binary())], names=["factor", "block", "slot", "slab"])

        slabs, left = docs.mapInArrow(run, schema), tasks
        while True:
            slabs = slabs.withColumn("slot", F.floor(F.col("slot") / _FAN)).groupBy("factor", "block", "slot").applyInArrow(_summed, schema)
            left = blocks_for(left, _FAN)
            if left == 1:
                break
        weights = tuple(w.copy() for w in weights)
        for row in slabs.collect():
            matrix = weights[row.factor][row.block * _SLAB : (row.block + 1) * _SLAB]
            both = np.frombuffer(row.slab).reshape(len(matrix), -1)
            seen = both[:, -1] > 0
            matrix[seen] = both[seen, :-1] / both[seen, -1:]
    return weights


def token_scores(tokens: Tokens, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each token's class and of its member there."""
    score = np.empty(len(tokens.kind))

    def add(matrix: np.ndarray, at: np.ndarray, rows: np.ndarray, columns: np.ndarray, given: np.ndarray) -> None:
        for low in range(0, len(at), BATCH):
            part = slice(low, low + BATCH)
            score[at[part]] = given[part] + log_softmax_at(matrix, rows[:, part], columns[part])

    add(weights[0], np.arange(len(score)), tokens.features(), tokens.kind, np.zeros(len(score)))
    at, rows = tokens.inner()
    add(weights[1], at, rows, tokens.member[at], score[at])
    return score / np.log(10)


SCORED = (
    "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, "
    "rare array<struct<word:binary,cell:long,n:long>>"
)


def _scored(docs: DataFrame, vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Each text's figures without its rare words' counts, and those words."""
    given = sent(docs.sparkSession, (vocabulary, weights))
    rare = pa.list_(pa.struct([("word", pa.binary()), ("cell", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = given()
        row = TaskContext.get().partitionId() << 40
        frequent_base, frequent_inside = known.base(known.count), known.inside(known.count, known.cell)
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                tokens = known.read(texts)
                score = token_scores(tokens, model)
                common = tokens.number >= 0
                base = np.zeros(len(score))
                base[common] = frequent_base[tokens.number[common]]
                score[common] += frequent_inside[tokens.number[common]]
                owner = np.repeat(np.arange(len(texts)), tokens.sizes)[tokens.rare].tolist()
                left: list[Counter] = [Counter() for _ in texts]
                cells = dict(zip(tokens.rare_words, tokens.cell[tokens.rare].tolist(), strict=True))
                for doc, word in zip(owner, tokens.rare_words, strict=True):
                    left[doc][word] += 1
                columns = [
                    pa.array(np.arange(row, row + len(texts))),
                    batch.column(0).slice(first, len(texts)),
                    pa.array(tokens.sizes),
                    pa.array(np.add.reduceat(common.astype(np.int64), tokens.starts)),
                    pa.array(np.add.reduceat(base, tokens.starts)),
                    pa.array(np.add.reduceat(score, tokens.starts)),
                    pa.array([[{"word": w, "cell": cells[w], "n": n} for w, n in c.items()] for c in left], rare),
                ]
                row += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare"])

    return docs.mapInArrow(run, SCORED)


def score_texts(docs: DataFrame, training, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`.

    `training` is a condition on the columns `doc_id` and `text`; the rows that meet it are
    learnt from. Scores are log10 probabilities of the text with its end. A null or empty text is
    its end alone. Without training rows every word is equally unknown and `base_score`
    is 0. Null and repeated keys and rows pass through, each repeated row counting
    again; other columns play no part; an empty table gives no rows.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    taught = docs.filter(training)
    counts = stored(_counted(taught), "lm-counts")
    sums = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("n")).first()
    # Words in bins of their count's logarithm, a thousand bins at most: the highest that hold FREQUENT in all.
    level = F.floor(F.log2("count") * 16)
    least, room = 0, FREQUENT
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        least, room = (r.level, room - r.n) if r.n <= room else (r.level + 1, 0)
        if not room:
            break
    frequent = sorted(counts.filter(level >= least).collect(), key=lambda r: (-r["count"], r.word))
    vocabulary = Vocabulary([(bytes(r.word), r["count"]) for r in frequent], sums.total, sums.n)
    for r in _cell_sums(counts, vocabulary).collect():
        vocabulary.cell_total[r.cell], vocabulary.cell_distinct[r.cell] = r.total, r.n
    weights = _trained(taught, vocabulary)
    scored = stored(_scored(docs, vocabulary, weights), "lm-scored")
    rooms = F.array(*map(F.lit, vocabulary.room().tolist()))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    rare = rare.join(counts, "word", "left").withColumn("c", F.coalesce("count", F.lit(0)))
    whole = float(vocabulary.total + 1 * (vocabulary.distinct + 1))
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(whole))).alias("base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.get(rooms, F.col("cell")))).alias("inside"),
    )
    found = scored.drop("rare").join(rare, "row", "left")
    added = {"n_known": "known", "base_score": "base", "score": "inside"}
    return found.select(
        F.col("doc_id").alias(key),
        "n_tokens",
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        *[(F.col(c) + F.coalesce(a, F.lit(0))).alias(c) for c, a in added.items()],
    )


HELD_OUT, FOLDS = 2, 7


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    found = score_texts(table(spark, sf_dir, "documents"), ~held)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op9_lm": op9_lm}
ORACLES: dict[str, str] = {}
