"""Language of texts by a bidirectional gated recurrent network over bytes, in numpy.

The network reads windows of bytes in both directions, gives every position a
distribution over languages, and a document the mean over its positions. It is fitted on
the driver, by backpropagation through time, to a bounded sample; every document is read
whole. Prediction is map-only.
"""

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import fold, map_batches, sent, table, text_chunks

# The sample: about so many documents of each language, chosen by a hash of the key, and
# one stretch of so many characters from each.
SAMPLE = 800
SAMPLE_CHARS = 64

HIDDEN = 6
# Bytes that the network sees at once; a text's windows don't overlap.
WINDOW = 128
EPOCHS = 25
BATCH = 256
RATE = 0.02
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
# Windows that are worked on together, so that one step's arrays stay in the cache.
_TOGETHER = 4096


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


class Direction:
    """One gated recurrent layer: hard-sigmoid gates, `tables` for the bytes, `back` for the state."""

    def __init__(self, rng: np.random.Generator):
        self.tables = rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32)
        self.back = rng.normal(0, 0.4, (HIDDEN, 3 * HIDDEN)).astype(np.float32)

    def forward(self, data: np.ndarray, mask: np.ndarray) -> list[tuple]:
        """Per position (state before, update, reset, candidate, its recurrent part, state)."""
        h = np.zeros((len(data), HIDDEN), np.float32)
        steps = []
        for t in range(data.shape[1]):
            x, u = self.tables[data[:, t]], h @ self.back
            z, r = (np.clip(0.25 * (x[:, a:b] + u[:, a:b]) + 0.5, 0, 1) for a, b in ((0, HIDDEN), (HIDDEN, 2 * HIDDEN)))
            n = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            new = np.where(mask[:, t, None], new, h)
            steps.append((h, z, r, n, u[:, 2 * HIDDEN :], new))
            h = new
        return steps

    def backward(self, data: np.ndarray, mask: np.ndarray, steps: list[tuple], slopes: np.ndarray) -> list[np.ndarray]:
        """Gradients of `tables` and `back` from those of the states, (batch, time, hidden)."""
        dtables, dback = np.zeros_like(self.tables), np.zeros_like(self.back)
        carry = np.zeros((len(data), HIDDEN), np.float32)
        into = np.empty((*data.shape, 3 * HIDDEN), np.float32)
        for t in reversed(range(data.shape[1])):
            h, z, r, n, un, _ = steps[t]
            live = mask[:, t, None]
            d = (carry + slopes[:, t]) * live
            dz = d * (h - n) * 0.25 * ((z > 0) & (z < 1))
            dn = d * (1 - z) * (1 - n * n)
            dr = dn * un * 0.25 * ((r > 0) & (r < 1))
            into[:, t] = np.concatenate([dz, dr, dn], axis=1)
            inner = np.concatenate([dz, dr, dn * r], axis=1)
            dback += h.T @ inner
            carry = d * z + inner @ self.back.T + (carry + slopes[:, t]) * ~live
        np.add.at(dtables, data.ravel(), into.reshape(-1, 3 * HIDDEN))
        return [dtables, dback]

    @cached_property
    def recurrent(self) -> np.ndarray:
        return np.ascontiguousarray(self.back.T)

    def step(self, h: np.ndarray, data: np.ndarray, live: np.ndarray | None) -> np.ndarray:
        """The next state, (hidden, windows), from one byte of every window."""
        x = np.take(self.tables, data, axis=0).T
        u = self.recurrent @ h
        gates = u[: 2 * HIDDEN]
        gates += x[: 2 * HIDDEN]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0, 1, out=gates)
        n = u[2 * HIDDEN :]
        n *= gates[HIDDEN:]
        n += x[2 * HIDDEN :]
        np.tanh(n, out=n)
        new = h - n
        new *= gates[:HIDDEN]
        new += n
        return new if live is None else np.where(live, new, h)


class Network:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Direction(rng), Direction(rng)
        self.out = rng.normal(0, 0.3, (2 * HIDDEN, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _parameters(self) -> list[np.ndarray]:
        return [self.ahead.tables, self.ahead.back, self.behind.tables, self.behind.back, self.out, self.bias]

    def gradients(self, data: np.ndarray, mask: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all positions; `label` holds one language a window."""
        turned, turned_mask = data[:, ::-1], mask[:, ::-1]
        ahead, behind = self.ahead.forward(data, mask), self.behind.forward(turned, turned_mask)
        states = np.concatenate(
            [np.stack([s[5] for s in ahead], 1), np.stack([s[5] for s in behind], 1)[:, ::-1]], axis=2
        )
        share = states @ self.out + self.bias
        share = np.exp(share - share.max(axis=2, keepdims=True))
        share /= share.sum(axis=2, keepdims=True)
        share[np.arange(len(data)), :, label] -= 1
        share *= mask[:, :, None] / max(1, mask.sum())
        slopes = share @ self.out.T
        return [
            *self.ahead.backward(data, mask, ahead, slopes[:, :, :HIDDEN]),
            *self.behind.backward(turned, turned_mask, behind, slopes[:, ::-1, HIDDEN:]),
            np.tensordot(states, share, ((0, 1), (0, 1))),
            share.sum((0, 1)),
        ]

    def fit(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 11) -> "Network":
        """Adam over shuffled batches, with a falling rate."""
        rng = np.random.default_rng(seed)
        longest = max(map(len, texts))
        data = np.zeros((len(texts), longest), np.uint8)
        for row, text in zip(data, texts, strict=True):
            row[: len(text)] = np.frombuffer(text, np.uint8)
        mask = np.arange(longest) < np.array([len(t) for t in texts])[:, None]
        label = np.array(labels)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self._parameters()]
        updates, done = epochs * -(-len(texts) // BATCH), 0
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for low in range(0, len(texts), BATCH):
                rows = order[low : low + BATCH]
                done += 1
                rate = RATE * (1 - (done - 1) / updates)
                for p, (m, v), g in zip(self._parameters(), moments, self.gradients(data[rows], mask[rows], label[rows]), strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.99**done)) + 1e-8)
        return self

    def _pool(self, windows: np.ndarray, lengths: np.ndarray | None, positions: bool = False) -> np.ndarray:
        """Sums over positions of the distributions, (windows, languages); or each position's best."""
        bytes_ = np.ascontiguousarray(windows.T)
        steps, count = bytes_.shape
        live = [None if lengths is None else t < lengths for t in range(steps)]
        h = np.zeros((HIDDEN, count), np.float32)
        states = []
        for t in range(steps):
            h = self.ahead.step(h, bytes_[t], live[t])
            states.append(h)
        from_ahead, from_behind = (np.ascontiguousarray(x.T) for x in (self.out[:HIDDEN], self.out[HIDDEN:]))
        h, sums = np.zeros((HIDDEN, count), np.float32), np.zeros((len(self.languages), count), np.float32)
        best = np.zeros((steps, count), np.int32) if positions else None
        for t in reversed(range(steps)):
            h = self.behind.step(h, bytes_[t], live[t])
            share = from_ahead @ states[t]
            share += from_behind @ h
            share += self.bias[:, None]
            if positions:
                best[t] = share.argmax(axis=0)
                continue
            share -= share.max(axis=0)
            np.exp(share, out=share)
            share /= share.sum(axis=0)
            if live[t] is not None:
                share *= live[t]
            sums += share
        return best.T if positions else sums.T

    def _windows(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """(number of the text, windows, their lengths or None if full)."""
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
        first = np.cumsum(sizes) - sizes
        whole, rest = sizes // WINDOW, sizes % WINDOW
        owner = np.repeat(np.arange(len(texts)), whole)
        start = np.repeat(first, whole) + WINDOW * (np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole))
        span = np.arange(WINDOW)
        for low in range(0, len(owner), _TOGETHER):
            rows = slice(low, low + _TOGETHER)
            yield owner[rows], data[start[rows, None] + span], None
        tails = np.flatnonzero(rest)
        tails = tails[np.argsort(rest[tails], kind="stable")]
        for low in range(0, len(tails), 512):
            rows = tails[low : low + 512]
            at = (first + whole * WINDOW)[rows, None] + np.arange(rest[rows].max())
            yield rows, data[np.minimum(at, len(data) - 1)], rest[rows]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Each text's mean distribution; zeros for an empty one."""
        sums = np.zeros((len(texts), len(self.languages)))
        for owner, windows, lengths in self._windows(texts):
            np.add.at(sums, owner, self._pool(windows, lengths))
        return sums / np.maximum(1, [len(t) for t in texts])[:, None]

    def positions(self, text: bytes) -> list[str]:
        """The language of every byte."""
        found = []
        for low in range(0, len(text), WINDOW):
            piece = np.frombuffer(text[low : low + WINDOW], np.uint8)[None]
            found += [self.languages[k] for k in self._pool(piece, None, positions=True)[0]]
        return found


def highest_hash(size: int, rows: int) -> int:
    """The signed 64-bit hash up to which about `size` of so many rows lie."""
    return min(2**63 - 1, int(min(1.0, size / rows) * 2**64) - 2**63)


def sample(docs: DataFrame, key: str, text: str, lang: str, size: int = SAMPLE) -> list[tuple[str, str]]:
    """(language, stretch): about `size` rows of every language, by a hash of the key, bounded by the two parameters."""
    rows = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = {r[lang]: r["count"] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return []
    # The hash is taken from all of its range, so a language of any size has its share.
    bar = F.coalesce(*[F.when(F.col(lang) == name, F.lit(highest_hash(size, n))) for name, n in counts.items()])
    digest = F.xxhash64(key, text)
    start = F.pmod(F.shiftrightunsigned(digest, 20), F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    picked = rows.filter(digest <= bar)
    picked = picked.select(F.col(lang).alias("lang"), F.substring(F.col(text), start, F.lit(SAMPLE_CHARS)).alias("text"))
    return sorted((r.lang, r.text) for r in picked.collect() if has_letter(r.text))


def fit_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network for the non-null languages of `docs`; None if no labelled text has a letter."""
    rows = sample(docs, key, text, lang)
    languages = sorted({name for name, _ in rows})
    if not languages:
        return None
    encoded = [t.encode("utf-8", "replace") for _, t in rows]
    return Network(languages).fit(encoded, [languages.index(name) for name, _ in rows])


def identify(
    docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """(key, columns to keep, lang_pred, score) for each row of `docs`.

    `score` is the mean probability of the predicted language over all positions. A
    text that is null or without a letter is `und` with score 0, as is every text if there
    is no network; of equally probable languages the first by name wins. Null and
    repeated keys pass through; columns not to keep play no part. None to keep may be
    named lang_pred or score.
    """
    sent_names, kept = list(dict.fromkeys([key, *keep, text])), list(dict.fromkeys([key, *keep]))
    docs = docs.select(*[F.col(c).cast("string").alias(c) if c == text else F.col(c) for c in sent_names])
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    place = sent_names.index(text)

    def work(batch: pa.RecordBatch, model: Network | None) -> pa.RecordBatch:
        names, scores = [], []
        for _, texts in text_chunks(batch.column(place), 4_000_000):
            pooled = None if model is None else model.pooled([t.encode("utf-8", "replace") for t in texts])
            for at, t in enumerate(texts):
                known = model is not None and has_letter(t)
                names.append(model.languages[int(pooled[at].argmax())] if known else UNDETERMINED)
                scores.append(min(1.0, float(pooled[at].max())) if known else 0.0)
        columns = [*batch.columns[: len(kept)], pa.array(names), pa.array(scores)]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    schema = ", ".join([*kinds, "lang_pred string, score double"])
    return map_batches(docs, work, schema, sent(docs.sparkSession, network))


HELD_OUT, FOLDS = 1, 3


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    found = identify(docs, fit_languages(docs.filter(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_language": op5_language}
ORACLES: dict[str, str] = {}
