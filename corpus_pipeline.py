"""A corpus made ready for training: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows
are written as Parquet and read again. The last stage's rows are the packed pieces.
Rows of `documents` that repeat are treated alike; rows without a doc_id are judged by
their text alone and are never near-duplicates of others. An empty table stays empty.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import fold, stored, table
from fareflow.llm.decontaminate import contaminated
from fareflow.llm.language import FOLDS, HELD_OUT, UNDETERMINED, fit_languages, identify
from fareflow.llm.line_dedup import dedup_lines
from fareflow.llm.near_dedup import near_duplicates
from fareflow.llm.packing import pack, public_tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# A document goes if the network is less sure than this of any language.
LEAST_SCORE = 0.4


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that are null, have no letter or read as none of the languages."""
    network = fit_languages(docs.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    found = identify(docs, network, keep=COLUMNS)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def by_line(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier document has; a document that loses its last line goes."""
    found = dedup_lines(docs, keep=("lang", "source"))
    found = found.filter((F.col("kept_lines") == F.col("n_lines")) | (F.trim("text") != ""))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def by_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near-duplicates, also of texts that share a doc_id: that of the smallest doc_id, then digest."""
    found = near_duplicates(docs).filter("doc_id IS NOT NULL")
    best = found.filter("group IS NOT NULL").groupBy("group").agg(F.min(F.struct("doc_id", "text_digest")).alias("best"))
    kept = best.select("best.*").unionByName(found.filter("group IS NULL").select("doc_id", "text_digest").distinct())
    docs = docs.select(*COLUMNS, F.xxhash64("text").alias("text_digest"))
    stay = docs.join(kept, ["doc_id", "text_digest"], "left_semi").unionByName(docs.filter("doc_id IS NULL"))
    return stay.select(*COLUMNS)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark passage, each judged by its text, whatever its doc_id."""
    docs = docs.select(*COLUMNS, F.xxhash64("text").alias("digest"))
    hits = contaminated(docs, table(spark, sf_dir, "benchmark"), key="digest").select(F.col("doc_id").alias("digest")).distinct()
    return docs.join(hits, "digest", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizer())


STAGES = [
    ("language", by_language),
    ("lines", by_line),
    ("near_duplicates", by_copy),
    ("benchmark", by_benchmark),
    ("packing", packed),
]

# Networks, SimHashes and signatures have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
