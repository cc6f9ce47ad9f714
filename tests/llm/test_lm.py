import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fareflow.llm import lm
from fareflow.llm.lm import BATCH, CLASSES, END, FEATURES, INNER, MEMBERS, NAMED, OWN, ROWS, Tokens, Trainer, Vocabulary, cell_of, log_softmax, score_texts


def plain_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w] + [END.decode()]


def plain_base(rows, taught):
    counts = Counter(w for k, t in rows if taught(k) for w in plain_tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for k, t in rows:
        tokens = plain_tokens(t)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        out.append((k, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 6)))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, word string")
    return score_texts(docs, F.col("doc_id") % 3 != 0).collect()


def corpus():
    rng = np.random.default_rng(3)
    stems = {name: ["".join(rng.choice(list(letters), 3)) + end for end in ends for _ in range(60)] for name, letters, ends in (("a", "abcde", ("ing", "er")), ("b", "vwxyz", ("ung", "en")))}
    return [(k, " ".join(rng.choice(stems["ab"[k % 2]], rng.integers(1, 120)))) for k in range(400)]


def check(found, rows, taught):
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=str) == plain_base(rows, taught)


def test_base_figures_with_and_without_a_short_frequent_list(spark, monkeypatch):
    rows = [*corpus(), (500, None), (501, ""), (502, "NEW Ä b words " * 50)]
    check(run(spark, rows), rows, lambda k: k % 3 != 0)
    monkeypatch.setattr(lm, "FREQUENT", 20)
    check(run(spark, rows), rows, lambda k: k % 3 != 0)


def test_the_model_beats_the_base_on_held_out_texts(spark):
    rows = corpus()
    held = [r for r in run(spark, rows) if r.doc_id % 3 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)
    assert all(r.score < 0 for r in held)


def test_the_frequent_list_does_not_change_scores(spark, monkeypatch):
    rows = corpus()[:60]
    monkeypatch.setattr(lm, "PASSES", 0)
    want = {r.doc_id: r.score for r in run(spark, rows)}
    monkeypatch.setattr(lm, "FREQUENT", 20)
    for r in run(spark, rows):
        assert abs(r.score - want[r.doc_id]) < 1e-3


def test_odd_tables(spark):
    rows = [(3, "a b"), (3, "a b"), (None, "a")]
    found = run(spark, rows)
    assert [(r.n_known, r.train_tokens, r.base_score) for r in found] == [(0, 0, 0.0)] * 3
    assert run(spark, []) == []
    long = [(1, "x y " * 100_000), (3, "x q")]
    check(run(spark, long), long, lambda k: k == 1)


def vocabulary():
    words = [(END, 50), (b"the", 40), (b"on", 30), (b"thing", 3)]
    known = Vocabulary(words, 123, 4)
    for word, count in words:
        known.cell_total[cell_of(word, known.own, known.named)] += count
        known.cell_distinct[cell_of(word, known.own, known.named)] += 1
    return known


def test_features_stay_inside_their_text():
    known = vocabulary()
    texts = [[b"the", b"on", b"rare", END], [END], [b"on", END], [b"thing"] * 5 + [END]]
    together = Tokens(known, texts).features()
    apart = np.concatenate([Tokens(known, [t]).features() for t in texts], axis=1)
    assert together.shape == (FEATURES, 13)
    assert (together == apart).all()
    assert together.min() >= 0 and together.max() < ROWS


def many_words():
    """More words than there are members for; counts fall."""
    rng = np.random.default_rng(4)
    return [(END, 5000)] + [(b"w%d" % k, 4000 - k) for k in range(3000)] + [(b"x" + bytes(rng.choice(list(b"abcdef"), 4)) + b"%d" % k, 3) for k in range(500)]


def settled(words, frequent):
    known = Vocabulary(words[:frequent], sum(c for _, c in words), len(words))
    for word, count in words:
        cell = cell_of(word, known.own, known.named)
        known.cell_total[cell] += count
        known.cell_distinct[cell] += 1
    return known


def plain_score(known, weights, counts, tokens):
    """One token after the other, with sums over single features."""
    def hashed(value, salt):
        value = (value ^ salt) * salt % 2**64
        value = (value ^ value >> 31) * 0xBF58476D1CE4E5B9 % 2**64
        return value >> (64 - (ROWS.bit_length() - 1))

    def softmax(matrix, rows, column):
        sums = sum(matrix[row].astype(np.float64) for row in rows)
        sums = np.clip(sums, -lm.LIMIT, lm.LIMIT)
        return sums[column] - math.log(np.exp(sums).sum())

    salts = [int(x) for x in lm._SALT]
    digest = lambda w: lm.xxhash.xxh3_64_intdigest(w)
    score, history = 0.0, [END] * 3
    for word in tokens:
        cell = cell_of(word, known.own, known.named)
        kind, member = divmod(cell, MEMBERS)
        last, before = digest(history[-1]), digest(history[-2])
        k1, k2, k3 = (cell_of(w, known.own, known.named) // MEMBERS for w in history[::-1])
        outer = (0, last, before, k1 * CLASSES + k2, k2 * CLASSES + k3, (last * 31 + k2) % 2**64)
        score += softmax(weights[0], [hashed(v, s) for v, s in zip(outer, salts)], kind)
        if kind >= OWN:
            inner = ((last + kind) % 2**64, (before + kind) % 2**64, (k1 * CLASSES + k2) * CLASSES + kind)
            score += softmax(weights[1], [ROWS + kind, *(hashed(v, s) for v, s in zip(inner, salts[FEATURES + 1 :]))], member)
            if member >= NAMED:
                score += math.log((counts.get(word, 0) + 1) / (known.cell_total[cell] + known.cell_distinct[cell] + 1))
        history = [*history[1:], word]
    return score / math.log(10)


def test_scores_equal_a_plain_softmax_token_by_token(spark, monkeypatch):
    rows = [*corpus()[:40], (501, ""), (502, "aaaing new words " * 5)]
    kept = {}

    def drawn(docs, known):
        rng = np.random.default_rng(6)
        kept["weights"] = tuple(rng.normal(0, 1, w.shape).astype(np.float32) for w in known.starting_weights())
        kept["known"] = known
        return kept["weights"]

    monkeypatch.setattr(lm, "_trained", drawn)
    monkeypatch.setattr(lm, "FREQUENT", 90)
    found = {r.doc_id: r.score for r in run(spark, rows)}
    counts = Counter(w for k, t in rows if k % 3 for w in [*lm.words(t), END])
    for key, text in rows:
        want = plain_score(kept["known"], kept["weights"], counts, [*lm.words(text), END])
        assert abs(found[key] - want) < 1e-4 * max(1, abs(want))


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    words = many_words()
    known = settled(words, 1000)
    outer, inner = (rng.normal(0, 3, w.shape).astype(np.float32) for w in known.starting_weights())
    assert np.allclose(np.exp(log_softmax(outer, rng.integers(0, ROWS, (FEATURES, 100))).astype(np.float64)).sum(axis=1), 1, atol=1e-3)
    assert np.allclose(np.exp(log_softmax(inner, rng.integers(0, ROWS, (INNER, 100))).astype(np.float64)).sum(axis=1), 1, atol=1e-3)
    cells = np.array([cell_of(w, known.own, known.named) for w, _ in words])
    inside = 10 ** known.inside(np.array([c for _, c in words]), cells)
    for cell in set(cells.tolist()):
        shared = cell // MEMBERS >= OWN and cell % MEMBERS >= NAMED
        unseen = 10 ** known.inside(np.array([0]), np.array([cell]))[0] if shared else 0
        assert abs(inside[cells == cell].sum() + unseen - 1) < 1e-9


def test_a_words_place_is_the_same_wherever_it_is_asked_for():
    words = many_words()
    known = settled(words, 1000)
    listed = {w for w, _ in words[:1000]}
    assert all(known.cell_of(w) == cell_of(w, known.own, known.named) for w, _ in words if w not in listed)
    assert set(known.named) <= listed
    places = [cell_of(w, known.own, known.named) for w in known.named]
    assert len(set(places)) == len(places)


def test_within_a_class_the_words_before_matter():
    """Words of one ending follow only their own word, so the class alone says nothing of which comes."""
    known = settled([(END, 100), *((b"own%d" % k, 900) for k in range(15)), (b"aaing", 800), (b"bbing", 800)], 18)
    assert cell_of(b"aaing", known.own, known.named) // MEMBERS == cell_of(b"bbing", known.own, known.named) // MEMBERS
    text = [b"own0", b"aaing", b"own1", b"bbing"] * 50 + [END]
    tokens = Tokens(known, [text])
    at, rows = tokens.inner()
    trainer = Trainer(known.starting_weights()[1])
    before = log_softmax(trainer.weights, rows)[np.arange(len(at)), tokens.member[at]]
    assert np.allclose(np.exp(before), 0.5, atol=0.01)
    for _ in range(20):
        trainer.learn(rows, tokens.member[at])
    assert np.exp(log_softmax(trainer.weights, rows)[np.arange(len(at)), tokens.member[at]]).min() > 0.9


def test_an_update_is_the_gradient_step():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 40, (FEATURES, 200))
    kinds = rng.integers(0, CLASSES, 200)
    trainer = Trainer(np.zeros((ROWS, CLASSES), np.float32))
    trainer.update(rows, kinds)
    slope = np.full((200, CLASSES), 1 / CLASSES)
    slope[np.arange(200), kinds] -= 1
    for row in range(40):
        hits = (rows == row).sum(axis=0)
        total = (slope * hits[:, None]).sum(axis=0) / np.sqrt(max(1, hits.sum()))
        want = -lm.RATE * total / np.sqrt(lm.FIRST_SQUARE + (total**2).mean())
        assert np.allclose(trainer.weights[row], want, atol=1e-4)
        assert trainer.seen[row] == hits.sum()
    before = -log_softmax(trainer.weights * 0, rows)[np.arange(200), kinds].mean()
    for _ in range(20):
        trainer.update(rows, kinds)
    assert -log_softmax(trainer.weights, rows)[np.arange(200), kinds].mean() < before
    assert BATCH > 0


def test_every_training_document_moves_the_weights(spark):
    words = [(END, 8), *((w, 10) for w in (b"a", b"b", b"c"))]
    known = settled(words, 4)
    for key in range(6):
        docs = spark.createDataFrame([(key, "a b c a b c")], "doc_id long, text string")
        rows = known.read(["a b c a b c"]).features()[1:]
        assert lm._trained(docs, known)[0][rows].any()


def test_sums_of_many_tasks_are_the_same_in_a_tree(spark, monkeypatch):
    known = settled(many_words(), 200)
    docs = spark.createDataFrame([(k, f"w{k} w{k + 1} xa{k} w{k}") for k in range(40)], "doc_id long, text string").repartition(10)
    monkeypatch.setattr(lm, "DOCS_PER_TASK", 1)
    wide = lm._trained(docs, known)
    monkeypatch.setattr(lm, "_FAN", 2)
    deep = lm._trained(docs, known)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(wide, deep))


def test_no_word_is_looked_up_one_by_one():
    """The frequent ones by Arrow, in one call; only the others become Python objects."""
    known = settled(many_words(), 200)
    assert not any(isinstance(value, dict) and len(value) >= 200 for value in vars(known).values())
    assert known.read([f"w{k} w{k + 1} zz{k}" for k in range(50)]).rare_words == [f"zz{k}".encode() for k in range(50)]


def test_texts_are_read_as_their_words():
    rng, letters = np.random.default_rng(8), [*"aAbBéİ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", " ", "\ud800"]
    frequent = [(END, 9), (b"a", 4), (b"bb", 3), ("é".encode(), 2)]
    for listed in (frequent, frequent[1:], []):
        known = Vocabulary(listed, 20, 9)
        number = {w: k for k, (w, _) in enumerate(listed)}
        for _ in range(300):
            texts = ["".join(rng.choice(letters, rng.integers(0, 9))) for _ in range(rng.integers(1, 5))]
            tokens, want = known.read(texts), [lm.words(t) + [END] for t in texts]
            assert tokens.sizes.tolist() == [len(w) for w in want]
            flat = [w for text in want for w in text]
            assert tokens.number.tolist() == [number.get(w, -1) for w in flat]
            assert tokens.rare_words == [w for w in flat if w not in number]
