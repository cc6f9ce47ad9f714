import random

import pytest

from fareflow.llm import decontaminate
from fareflow.llm.decontaminate import contaminated

WORDS = [f"word{k}" for k in range(3000)]
SCHEMA_D, SCHEMA_B = "doc_id long, text string, item_id string", "item_id long, text string"


def text(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def hits(spark, docs, items):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], SCHEMA_D)
    found = contaminated(d, spark.createDataFrame(items, SCHEMA_B)).collect()
    return sorted(((r.doc_id, r.item_id, r.doc_start, r.doc_end, r.matched) for r in found), key=str)


def test_verbatim_partial_and_substituted_passages(spark):
    item = text(1, 40)
    words = item.split()
    swapped = words.copy()
    for k in range(4, 40, 9):
        swapped[k] = "other"
    docs = [
        (1, f"{text(2, 300)} {item.upper()} {text(3, 100)}"),
        (2, text(4, 400)),
        (3, " ".join([text(5, 10), *swapped, text(6, 10)])),
        (4, " ".join([text(7, 50), *words[10:30], text(8, 50)])),
        (5, " ".join([text(9, 50), *words[:8], text(10, 50)])),
        (6, ", ".join(words)),
    ]
    assert hits(spark, docs, [(9, item)]) == [(1, 9, 300, 340, 40), (3, 9, 10, 50, 36), (4, 9, 50, 70, 20), (6, 9, 0, 40, 40)]


def test_every_passage_with_one_word_in_eight_replaced(spark):
    items = [(k, text(100 + k, 30 + k % 20)) for k in range(60)]
    docs = []
    for k, item in items:
        words = item.split()
        for at in range(k % 8, len(words), 8):
            words[at] = "zzz"
        docs.append((k, f"{text(500 + k, 80)} {' '.join(words)} {text(900 + k, 80)}"))
    assert [(h[0], h[1]) for h in hits(spark, docs, items)] == sorted(((k, k) for k, _ in items), key=str)


def test_short_items_match_whole_and_exactly(spark):
    docs = [(1, "a b one two three four five six c"), (2, "one two three four five seven"), (3, "p q r s")]
    assert hits(spark, docs, [(1, "One, two: three four five six"), (2, "p q r s")]) == [(1, 1, 2, 8, 6)]


def test_odd_rows(spark):
    item = text(1, 20)
    docs = [(None, item), (1, None), (2, ""), (3, item), (3, item), (4, text(8, 300_000) + " " + item)]
    items = [(1, item), (2, item), (None, None), (3, ""), (4, "x")]
    found = hits(spark, docs, items)
    assert [(h[0], h[1]) for h in found] == sorted([(d, i) for d in (3, 3, 4, None) for i in (1, 2)], key=str)
    assert hits(spark, [], items) == hits(spark, docs, []) == []


def test_a_benchmark_in_blocks_finds_the_same(spark, monkeypatch):
    items = [(k, text(k, 30)) for k in range(20)]
    docs = [(k, f"{text(50, 30)} {t}") for k, t in items]
    whole = hits(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1000)
    assert hits(spark, docs, items) == whole
    assert len(whole) == 20


@pytest.mark.parametrize("n", [12, 13, 14])
def test_items_about_a_window_long(spark, n):
    item = text(n, n)
    assert hits(spark, [(1, f"{text(77, 20)} {item} {text(78, 20)}")], [(1, item)]) == [(1, 1, 20, 20 + n, n)]


def test_a_document_that_is_a_piece_of_a_long_item(spark):
    item = text(1, 100)
    words = item.split()
    docs = [(k, " ".join(words[k : k + 20])) for k in range(0, 81, 5)]
    assert hits(spark, docs, [(1, item)]) == sorted(((k, 1, 0, 20, 20) for k, _ in docs), key=str)


@pytest.mark.parametrize(("n", "replaced"), [(13, 1), (13, 2), (14, 2), (15, 2), (15, 3), (16, 2), (18, 3), (24, 4)])
def test_short_items_with_words_replaced(spark, n, replaced):
    r, docs, items = random.Random(n), [], []
    for k in range(60):
        item = text(1000 + k, n)
        words = item.split()
        places = r.sample(range(n), replaced)
        if n == 15 and sorted(places) == [3, 7, 11]:
            continue
        for at in places:
            words[at] = "zzz"
        items.append((k, item))
        docs.append((k, " ".join([text(2000 + k, 30), *words, text(3000 + k, 30)])))
    assert [h[:2] for h in hits(spark, docs, items)] == sorted(((k, k) for k, _ in docs), key=str)


def test_copies_of_an_item_reach_the_driver_once(spark, monkeypatch):
    given = []

    class Seen(decontaminate.Index):
        def __init__(self, items):
            given.extend(items)
            super().__init__(items)

    monkeypatch.setattr(decontaminate, "Index", Seen)
    item, other = text(1, 20), text(2, 20)
    items = [*((k, item) for k in range(50)), (50, other), (None, other)]
    found = hits(spark, [(1, item), (2, other)], items)
    assert len(given) == 2
    assert sorted(((h[0], h[1]) for h in found), key=str) == sorted([*((1, k) for k in range(50)), (2, 50), (2, None)], key=str)
