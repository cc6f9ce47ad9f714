"""Chat logs as events, folded into final messages and rendered for training.

Only DataFrame functions. The log is partitioned by conversation once; windows, the
fold of each message and the rendering all reuse that partitioning. A conversation
ends as one row, so it has to fit one; the sort before it spills.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.llm.common import table

# Kinds of events, and the template's control strings.
DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"
HEAD, TAIL = "### ", "\n</turn>\n"
CONTROL = "###|</turn>"

# The conversation that quotes the template, added to the query's input.
QUOTING = (-7, "\\### Assistant: </turn> ok")


def escaped(text: Column) -> Column:
    """One backslash more before each control string, after those that stand there already.

    A marker of the template never has a backslash before it: the end of a turn has a
    line end there. So the two can't be taken for each other.
    """
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*)({CONTROL})", "$1$2")


def escaped_role(role: Column) -> Column:
    """A role on one line."""
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) from events (conv_id, seq, kind, message, role, text).

    By `seq`, a `delta` adds to its message's text, an `edit` puts its text in place of
    all before, a `regenerate` empties its message (its own text, if any, begins the new
    one) and voids all earlier events of later messages. A message without a standing
    event is gone. Events of one `seq` follow kind, then text. Null text counts as empty, a
    message has its last role that is not null (else an empty one), a null message number as 0, a
    null kind as `delta`; null conversations are one. Repeated events count each time.
    """
    log = events.select(
        "conv_id",
        F.coalesce(F.col("message").cast("long"), F.lit(0)).alias("message"),
        F.col("seq").cast("long").alias("seq"),
        F.coalesce("kind", F.lit(DELTA)).alias("kind"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    renewed = F.when(F.col("kind") == REGENERATE, F.col("seq"))
    reset = F.when(F.col("kind").isin(EDIT, REGENERATE), F.col("seq"))
    before = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id", "message")
    since = F.greatest(F.max(reset).over(whole), F.max(renewed).over(before))
    named = F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).over(whole)
    log = log.select("*", since.alias("since"), named.role.alias("named")).filter(F.col("since").isNull() | (F.col("seq") >= F.col("since")))
    reset_first = F.when(F.col("kind") == DELTA, 1).otherwise(0)
    event = F.struct("seq", reset_first.alias("later"), "kind", "text")
    events = F.array_sort(F.collect_list(event)).alias("events")
    folded = log.groupBy("conv_id", "message").agg(F.max("named").alias("role"), events)
    return folded.select(
        "conv_id",
        "message",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform("events", lambda e: e.text), "").alias("text"),
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, pieces): each conversation as one text.

    `pieces` are the text's parts in order with their loss flag, which holds for the
    texts of role `learn` alone; put together they are `formatted`.
    """
    turn = F.array(
        F.struct(F.concat(F.lit(HEAD), escaped_role(F.col("role")), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(F.col("text")).alias("text"), (F.col("role") == learn).alias("loss")),
        F.struct(F.lit(TAIL).alias("text"), F.lit(False).alias("loss")),
    )
    turns = F.array_sort(F.collect_list(F.struct("message", turn.alias("pieces"))))
    rows = messages.groupBy("conv_id").agg(turns.alias("turns"))
    pieces = F.flatten(F.transform("turns", lambda t: t.pieces))
    rows = rows.select("conv_id", pieces.alias("pieces"))
    return rows.select("conv_id", F.array_join(F.transform("pieces", lambda p: p.text), "").alias("formatted"), "pieces")


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a rendered text."""
    parts = F.split(formatted, TAIL, -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    head = rf"(?s)\A{HEAD}([^\n]*)\n"
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped_role(F.regexp_extract(t, head, 1)).alias("role"),
            unescaped(F.regexp_replace(t, head, "")).alias("text"),
        ),
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log of a finished table: each row streams one message whole, by turn, role, text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("message")).select(
        "*", F.col("message").alias("seq"), F.lit(DELTA).alias("kind")
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, quote = QUOTING
    quoting = spark.range(1).select(
        F.lit(conv).cast("long").alias("conv_id"),
        F.explode(
            F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))])
        ).alias("t"),
    )
    quoting = quoting.select("conv_id", "t.turn", "t.role", F.lit(quote).alias("text"))
    rendered = render(fold_events(conversation_events(rows.unionByName(quoting))))
    rendered = rendered.select("*", parse(F.col("formatted")).alias("turns"))
    learnt = F.transform(F.filter("pieces", lambda p: p.loss), lambda p: unescaped(p.text))
    rendered = rendered.select("*", F.array_join(learnt, "").alias("learnt"))
    spelled = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return rendered.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spelled, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES = {"op3_chat": op3_chat}
ORACLES = {
    "op3_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
        ), spelled AS (
            SELECT *, regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g') AS inside,
                replace(replace(role, '\', '\b'), chr(10), '\n') AS head
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length(inside) + length(head) + 14) AS BIGINT) AS formatted_chars
        FROM spelled GROUP BY conv_id
    """
}
