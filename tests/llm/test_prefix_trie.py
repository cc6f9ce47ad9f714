import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fareflow.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, pos int, k string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 9, "clash") for r in rows], SCHEMA).repartition(parts)


def in_order(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = convs.get(first, [])[:h] + own[h:]
    return out


def plain(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for prefix in members:
        if prefix:
            kids[prefix[:-1]].append(prefix)
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids[prefix]]
        saved = (len(members[prefix]) - 1) * (len(prefix[-1][1]) if prefix else 0) + sum(s for s, _ in below)
        sums[prefix] = saved, sum(n for _, n in below) or 1
    rows = []
    for prefix, who in members.items():
        ends = ",".join(str(c) for c in who if len(convs[c]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        rows.append((who[0], len(prefix), parent, len(who), len(kids[prefix]), sums[prefix][1], sums[prefix][0], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def collected(df):
    assert df.columns == list(COLUMNS)
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(seed, ids):
    rng = random.Random(seed)
    rows = []
    for c in ids:
        for turn in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 13])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["a", "bb", "é😀", ""])))
    return rows


@pytest.mark.parametrize("block", [1, 2, 4, 50])
def test_tries_of_any_block_size(spark, block):
    rows = random_rows(block, range(60))
    rows += [(100 + c, t, "user", "same") for c in range(20) for t in range(6)]
    assert collected(P.conversation_trie(table(spark, rows), block)) == plain(in_order(rows))


def test_rebuilt_conversations_nulls_ties_and_odd_ids(spark):
    rows = random_rows(9, [*range(0, 12), *range(100, 112), 200, 305, 306, 399, -7, -100, -105, 10**15 + 3])
    rows += [(c, t, None, None) for c in (420, 421) for t in (None, None, 1, 1)]
    rows += [(500, 3, "user", "b"), (500, 3, "user", "a"), (500, None, "user", "c"), (501, 1, "x", "only"), (None, 1, "user", "no id")]
    rows += [(500, 3, "user", "b")] * 3 + [(502, 0, "user", "long " * 50_000)]
    want = rebuilt(in_order(rows))
    assert any(not turns for turns in want.values())
    got = collected(P.prefix_trie(*P.with_shared_heads(P.placed_turns(table(spark, rows)))))
    assert got == plain(want)


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "SEGMENT", 3)
    rng = random.Random(2)
    long = [(7, t, "user", rng.choice(["a", "bb"])) for t in range(400)]
    rows = [*long, *((8, t, r, x) for _, t, r, x in long), *((9, t, r, x) for _, t, r, x in long[:333]), (9, 333, "user", "other"), *random_rows(3, range(20, 40))]
    assert collected(P.conversation_trie(table(spark, rows, 8))) == plain(in_order(rows))


def test_places_run_on_over_tasks(spark):
    rows = [(5, t, "user", str(t % 3)) for t in range(2000)] + [(4, 0, "u", "x"), (6, 0, "u", "x"), (6, 1, "u", "y")]
    found = P.placed_turns(table(spark, rows, 8)).select("conv_id", "pos").collect()
    assert sorted(map(tuple, found)) == sorted((c, t) for c, t, *_ in rows)


def test_many_copies_and_nothing_at_all(spark):
    rows = [(c, t, "user", "hello") for c in range(3000) for t in range(2)] + [(5000, 0, "user", "hello")]
    assert collected(P.conversation_trie(table(spark, rows))) == plain(in_order(rows))
    assert collected(P.conversation_trie(table(spark, []))) == []
    assert collected(P.prefix_trie(*P.with_shared_heads(P.placed_turns(table(spark, [(None, 1, "a", "b")]))))) == []


def test_roles_and_texts_are_told_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "abc", ""), (5, 0, "1:a", "")]
    assert collected(P.conversation_trie(table(spark, rows))) == plain(in_order(rows))
