"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents; rows that a stage keeps are unchanged but for the text that substring dedup
cuts. Defined cases are those of the operators; besides, null ids stay in every stage
that finds no fault with their text (of a near-duplicate group they stay only where all
its ids are null, and then one row does), a row that repeats another whole row is one of
its copies, and columns of docs other than those of documents are dropped by the first stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm import decontaminate, language, pieces, simhash, substrings
from cashweave.llm.base import fold, shared_folder, staged, table, unnamed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least share of a text that its main language must have.
MAIN_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a determined main language go: no letters, or no language with half of it."""
    docs = unnamed(docs, *COLUMNS)
    taught = language.learn(docs.where(fold("doc_id", 5) != 0))
    found = language.identify(docs, taught, keep=("text", "lang", "source", "n_chars"))
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MAIN_SHARE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints (three-word shingles, 3 bits) the row of the least id stays."""
    kept = simhash.least_of_groups(docs, words=3, bits=3, keep=tuple(COLUMNS[1:]))
    return kept.select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 13 that an earlier document has are cut out; emptied texts go. n_chars follows the text."""
    done = substrings.dedup_substrings(unnamed(docs, *COLUMNS), keep=("lang", "source", "n_chars"), layout=True)
    left = done.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", chars.alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have an item of the benchmark go."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found.hint("shuffle_hash"), "doc_id", "left_anti").select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (the end id last), the bytes of the text that each is from, and the ids decoded."""
    return pieces.encode(docs, pieces.model_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_leaks),
    ("encoding", encode_pieces),
]

#: Learned models, similarity groups and subword encoding: SQL does not express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
