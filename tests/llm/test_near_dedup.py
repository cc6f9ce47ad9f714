import random

import numpy as np

from fareflow.llm import near_dedup
from fareflow.llm.near_dedup import MISS, VALUES, compare, least_equal, near_duplicates, shingles, signature


def plain(texts):
    """doc -> (set size, component) by comparing all pairs."""
    sets = {}
    for k, t in texts:
        words = (t or "").encode().lower().split()
        n = max(1, len(words) - 4)
        sets[k] = {tuple(words[i : i + 5]) for i in range(n)} if words else set()
    up = {k: k for k in sets}

    def root(k):
        return k if up[k] == k else root(up[k])

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def found(spark, rows):
    docs = spark.createDataFrame([(k, t, "clash", 5) for k, t in rows], "doc_id long, text string, node string, high int")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    rows = []
    for _ in range(60):
        base = r.choices(vocabulary, k=r.choice([3, 8, 30, 120, 400]))
        for _ in range(r.choice([1, 1, 2, 30])):
            words = base.copy()
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append(" ".join(words))
    r.shuffle(rows)
    return list(enumerate(rows))


def test_components_as_by_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert found(spark, rows) == plain(rows)


def test_a_chain_longer_than_a_block_joins(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([f"v{j}" if j < k % 7 else words[j] for j in range(60)]) + f" end{k}") for k in range(1300)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (5, "a  B\n"), (6, "a b c"), (7, "a\u00a0b c d e"), (8, "a b c d e")]
    assert found(spark, rows) == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7), 8: (1, 8)}
    assert found(spark, []) == {}


def test_repeated_and_missing_keys(spark):
    docs = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (6, "a b c d e f"), (6, "other text")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (None, None, True), (6, 5, False), (6, 6, True)], key=str)


def test_links_outlast_the_posterior_and_far_pairs_do_not():
    r = np.random.default_rng(3)
    kept = {}
    for share in (0.75, 0.5):
        kept[share] = 0
        for _ in range(200):
            n = 400
            both = round(n * share * 2 / (1 + share))
            pool = r.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = pool[:n], pool[n - both : 2 * n - both]
            prints = np.stack([signature(a), signature(b)]).view(np.uint8)
            kept[share] += compare(prints, np.array([0]), np.array([1]))[0].sum()
    assert kept[0.75] >= 198
    assert kept[0.5] <= 20
    assert 0 < least_equal(VALUES, MISS) < 0.75 * VALUES


def test_long_texts_are_hashed_whole():
    words = [f"w{k}" for k in range(50_000)]
    assert len(shingles(" ".join(words))) == 49_996


def test_texts_with_the_same_smallest_key_keep_their_own_links(spark):
    r = random.Random(9)
    text = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    for _ in range(3):
        one, other = text(100), text(100)
        rows = [(1, one), (1, other), (2, one + " tail"), (3, other + " tail"), (4, text(100))]
        assert found(spark, rows) == {1: (96, 1), 2: (97, 1), 3: (97, 1), 4: (96, 4)}


def test_many_texts_of_one_key_are_read_once_each(spark, monkeypatch):
    """The join that fetches the texts makes one row for each, not one for each pair."""
    r = random.Random(11)
    text = lambda n: " ".join(f"w{r.randrange(90_000)}" for _ in range(n))
    pairs = [text(40) for _ in range(500)]
    rows = [(1, t) for t in pairs] + [(1, f"{t} tail") for t in pairs]
    rows_read = spark.sparkContext.accumulator(0)
    sets = near_dedup._set_batches

    def counted(batches):
        def seen():
            for batch in batches:
                rows_read.add(batch.num_rows)
                yield batch

        return sets(seen())

    monkeypatch.setattr(near_dedup, "_set_batches", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = near_duplicates(docs).collect()
    assert rows_read.value == 1000
    groups = {}
    for row in result:
        groups.setdefault(row.group, []).append(row.text_digest)
    assert len(groups) == 500 and all(len(set(g)) == 2 for g in groups.values())
    assert all(row.component_id == 1 and row.kept for row in result)
