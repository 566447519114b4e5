"""The corpus pipeline: documents through five operators, each stage written as
Parquet and read again as the next one's documents.

Every stage works on all rows its predecessor kept. All but the last return the
columns of ``documents``; the last returns the encoded documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwise.llm import bpe, jaccard, pii, repetition, spaced
from fieldwise.llm.common import bounded_batches, documents, free_name, without_rows, written
from fieldwise.llm.queries import WORD_BPE
from fieldwise.session import ensure_semantics

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rows that the repetition rules reject go, null and blank texts among them.

    Rows are judged one by one, whatever their ids and other columns; an empty table stays empty."""
    return repetition.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of linked documents the one with the smallest id stays.

    Rows, not ids, go: of several rows of that id, or of rows without an id, one stays, and of
    rows repeated with id and text, one. Rows without a word are linked with nothing and stay."""
    gone, copies = jaccard.repeated_rows(docs)
    return without_rows(docs, jaccard.row_key("doc_id", "text"), gone, copies)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that overlap a benchmark item go, row by row, whatever their ids.

    Null and empty texts overlap nothing; without items all rows stay."""
    key = jaccard.row_key("doc_id", "text")
    name = free_name(docs, "_row")
    found = spaced.overlaps(docs.select(key.alias(name), "text"), documents(spark, sf_dir, "benchmark"), doc_col=name)
    return without_rows(docs, key, written(found.select(F.col("doc").alias("row")).distinct(), "found"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every span of personal data gives way to its kind; ``n_chars`` follows the text.

    Null and empty texts stay as they are, and all other columns, whatever their names."""
    aside = [f"c{i}" for i in range(len(docs.columns))]  # no name that the operator uses
    text, n_chars = (aside[docs.columns.index(c)] for c in ("text", "n_chars"))
    rows = docs.toDF(*aside)
    found = pii.find(rows, pii.train(rows, text), text)
    masked = found.withColumn(text, pii.masked(text))
    return masked.withColumn(n_chars, F.length(text).cast(docs.schema["n_chars"].dataType)).select(*aside).toDF(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document's number of ids, and the hashes of its ids and of the decoded text.

    A null text counts as empty; every row gives a row."""
    return bpe.digests(docs, WORD_BPE)


def _bounded(stage: Stage) -> Stage:
    """The stage with batches of bounded size, however the session came to it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _bounded(quality_rules)),
    ("ngram_jaccard", _bounded(near_duplicates)),
    ("decontamination", _bounded(decontamination)),
    ("pii", _bounded(personal_data)),
    ("encoding", _bounded(encoding)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage but the last is written and reread."""
    ensure_semantics(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages that fit models or follow links have no SQL form; brute-force tests hold them.
ORACLE_SQL = None
