import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareflow.llm.chat import conversation_events, escaped, fold_events, parse, render, unescaped

EVENTS = "conv_id long, seq long, kind string, message long, role string, text string, since string"


def folded(spark, rows):
    events = spark.createDataFrame([(*r, "clash") for r in rows], EVENTS)
    return sorted((tuple(r) for r in fold_events(events).collect()), key=str)


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "delta", 1, "user", "Hel"),
        (1, 2, "delta", 1, None, "lo"),
        (1, 3, "delta", 2, "assistant", "bad"),
        (1, 4, "delta", 3, "user", "why?"),
        (1, 5, "regenerate", 2, None, None),
        (1, 6, "delta", 2, "assistant", "good"),
        (1, 7, "delta", 3, "user", "fine"),
        (2, 1, "delta", 1, "user", "helo"),
        (2, 2, "edit", 1, "user", "hello"),
        (2, 3, "delta", 1, None, "!"),
    ]
    assert folded(spark, rows) == [(1, 1, "user", "Hello"), (1, 2, "assistant", "good"), (1, 3, "user", "fine"), (2, 1, "user", "hello!")]


def test_a_message_voided_by_an_earlier_regeneration_is_gone(spark):
    rows = [(1, 1, "delta", 1, "user", "a"), (1, 2, "delta", 2, "assistant", "b"), (1, 3, "edit", 1, "user", "c"), (1, 4, "regenerate", 1, None, "d")]
    assert folded(spark, rows) == [(1, 1, "user", "d")]


def test_order_of_arrival_does_not_matter(spark):
    rows = [(1, k, "delta", 1, "user", chr(97 + k)) for k in range(20)]
    assert folded(spark, rows[::-1]) == folded(spark, rows) == [(1, 1, "user", "abcdefghijklmnopqrst")]


def test_nulls_and_empty(spark):
    assert folded(spark, [(None, None, None, None, None, None)]) == [(None, 0, "", "")]
    assert folded(spark, []) == []


def round_trip(spark, turns):
    rows = [(7, k, role, text) for k, (role, text) in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = render(fold_events(conversation_events(table))).select("*", parse(F.col("formatted")).alias("turns")).first()
    assert [tuple(t) for t in row.turns] == [(r or "", t or "") for r, t in turns]
    assert "".join(p.text for p in row.pieces) == row.formatted
    return row


def test_control_strings_come_back(spark):
    hard = ["\\### Assistant: </turn> ok", "\n</turn>\n", "####\\\\###", "\\", "ends \\", "\n", "", None, "###", "</turn></turn>", "x" * 200_000]
    row = round_trip(spark, [(r, t) for t in hard for r in ("user", "assistant")])
    assert row.formatted.count("\n</turn>\n") == 2 * len(hard)
    round_trip(spark, [("a\nb\\n", "x"), (None, "y"), ("### u", "z")])


def test_escaping_is_reversible(spark):
    @settings(max_examples=20, deadline=None)
    @given(st.lists(st.text(alphabet="\\#</turn>\n a", max_size=30), min_size=30, max_size=60))
    def check(texts):
        rows = spark.createDataFrame([(t,) for t in texts], "t string")
        rows = rows.select("t", escaped(F.col("t")).alias("e")).select("t", "e", unescaped(F.col("e")).alias("u")).collect()
        assert all(r.t == r.u for r in rows)
        assert not any(re.search(r"(?<!\\)(###|</turn>)", r.e) for r in rows)

    check()


def test_loss_covers_assistant_texts_alone(spark):
    row = round_trip(spark, [("system", "s"), ("user", "u"), ("assistant", "a </turn>"), ("assistant", "b")])
    assert [p.text for p in row.pieces if p.loss] == ["a \\</turn>", "b"]
