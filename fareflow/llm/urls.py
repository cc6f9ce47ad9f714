"""URL verdicts: rules first, else the likelihood ratio of two character models.

Only DataFrame functions. Characters fall into 31 classes, so a model of order 3 has at
most 31^4 = 923,521 entries whatever the input: that bound is what lets it be broadcast.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import fold, stored, table

# Character classes are a-z, one for all digits, `.`, `/`, `-`, one for others, one for the start.
SYMBOLS = 31
START, OTHER = "^", "~"
ORDER = 3


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The query's rules.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Contexts seen less often (in both classes together) are not used: the model backs off.
MIN_CONTEXT = 4
# One in so many labelled URLs is kept from the models and sets the threshold.
CALIBRATION_FOLDS = 5
# Width of the calibration's score bins, and the scores' range.
BIN, RANGE = 0.01, 20.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct of the longest fitting rule's name and verdict, or null."""
    fitting = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    ]
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")


def symbols(url: Column) -> Column:
    """The URL after its scheme in character classes; empty if null."""
    rest = F.translate(F.regexp_replace(url, r"(?s)\A.*?://", ""), _UPPER, _LOWER)
    classed = F.regexp_replace(F.regexp_replace(rest, "[0-9]", "0"), "[^a-z0./-]", OTHER)
    return F.coalesce(classed, F.lit(""))


def _grams(strings: DataFrame) -> DataFrame:
    """A row for each character: it and the `ORDER` before it."""
    padded = F.concat(F.lit(START * ORDER), F.col("symbols"))
    at = F.explode(F.sequence(F.lit(1), F.length("symbols")))
    rows = strings.filter(F.length("symbols") > 0).select("*", padded.alias("padded"), at.alias("at"))
    return rows.select(*strings.columns, F.substring("padded", F.col("at"), F.lit(ORDER + 1)).alias("gram"))


def _shorter(grams: DataFrame) -> DataFrame:
    """Counts of the grams of one order less: each is the end of some longer one."""
    return grams.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _ratios(counts: DataFrame) -> DataFrame:
    """(gram, ratio) for every gram of full order: log P(last | rest) under `a` less that under `b`.

    Witten-Bell: an order's estimate gives the order below the weight of as many
    unseen characters as the context had different ones. Contexts too rare are passed over.
    """
    levels = [counts]
    for _ in range(ORDER):
        levels.append(_shorter(levels[-1]))
    below = None
    for k, grams in enumerate(reversed(levels)):
        context = F.expr(f"substring(gram, 1, {k})")
        totals = grams.groupBy(context.alias("context")).agg(
            *[F.sum(c).alias(f"n{c}") for c in "ab"], *[F.count_if(F.col(c) > 0).alias(f"t{c}") for c in "ab"]
        )
        rows = grams.withColumn("context", context).join(totals, "context")
        used = F.col("na") + F.col("nb") >= (MIN_CONTEXT if k else 0)
        if below is None:
            lower = {c: F.lit(1.0 / SYMBOLS) for c in "ab"}
        else:
            rows = rows.withColumn("end", F.expr("substring(gram, 2)")).join(
                below.select(F.col("gram").alias("end"), F.col("pa").alias("la"), F.col("pb").alias("lb")), "end"
            )
            lower = {c: F.col(f"l{c}") for c in "ab"}
        estimate = {
            c: F.when(
                used & (F.col(f"n{c}") > 0),
                (F.col(c) + F.col(f"t{c}") * lower[c]) / F.greatest(F.col(f"n{c}") + F.col(f"t{c}"), F.lit(1)),
            ).otherwise(lower[c])
            for c in "ab"
        }
        below = rows.select("gram", *[estimate[c].alias(f"p{c}") for c in "ab"])
    return below.select("gram", (F.log("pa") - F.log("pb")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """The score from which an allowed URL is as rarely lost as a blocked one let through.

    The bins are at most 2 * RANGE / BIN, whatever the input. 0 if a class is missing.
    """
    held = scored.filter((F.col("held") == 0) & F.col("score").isNotNull())
    edge = F.round(F.greatest(F.least("score", F.lit(RANGE)), F.lit(-RANGE)) / BIN).cast("long")
    bins = held.groupBy(edge.alias("bin")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    bins = sorted((r.bin, r.a, r.b) for r in bins.collect())
    allowed, blocked = sum(x[1] for x in bins), sum(x[2] for x in bins)
    if not allowed or not blocked:
        return 0.0
    best, at, lost, caught = 1.0, 0.0, 0, 0
    for k, a, b in bins:
        if (error := (lost / allowed + 1 - caught / blocked) / 2) < best:
            best, at = error, (k - 0.5) * BIN
        lost, caught = lost + a, caught + b
    return at


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score) for each row of `pages`.

    URLs that a rule allows or blocks teach the two models, a fold of them the threshold.
    `score` is the log-likelihood difference for each character; the verdict without a
    rule is `allow` from the threshold on. A null or empty URL has no host, path or
    score and is judged as score 0. Equal URLs are scored once and judged alike; other
    columns play no part. Without rules that fit, every score is 0 and everything allowed.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    rows = rows.select("key", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), symbols(F.col("url")).alias("symbols"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    strings = rows.groupBy("symbols").agg(
        F.count_if(F.col("fit.verdict") == "allow").alias("a"), F.count_if(F.col("fit.verdict") == "block").alias("b")
    )
    strings = stored(strings.withColumn("held", fold(F.col("symbols"), CALIBRATION_FOLDS)), "urls")
    taught = F.col("held") != 0
    counts = _grams(strings).groupBy("gram").agg(*[F.sum(F.when(taught, F.col(c)).otherwise(0)).alias(c) for c in "ab"])
    ratios = stored(_ratios(stored(counts, "url-grams")), "url-model")
    scored = _grams(strings).join(F.broadcast(ratios), "gram").groupBy("symbols", "held", "a", "b").agg(F.avg("ratio").alias("score"))
    scored = stored(scored, "url-scores")
    threshold = _threshold(scored)
    return rows.join(scored.select("symbols", "score"), "symbols", "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(
            F.col("fit.verdict"),
            F.when(F.coalesce("score", F.lit(0.0)) >= threshold, F.lit("allow")).otherwise("block"),
        ).alias("verdict"),
        "score",
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


QUERIES = {"op7_urls": op7_urls}
ORACLES: dict[str, str] = {}
