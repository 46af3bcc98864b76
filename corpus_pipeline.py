"""Cleaning of a corpus in stages, from documents to packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the
columns of its input; the last returns the pieces of packed sequences. ``n_chars``, where
there is one, follows a changed text. NULL texts have no language and go in the first
stage; NULLs in other columns, repeated rows and further columns are handled as the
operators say. An empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymeter.llm import languages, lines, secrets, simhash
from skymeter.llm.columns import unused
from skymeter.llm.packing import packed_documents
from skymeter.llm.queries import WORD_TOKENIZER
from skymeter.session import materialize
from skymeter.sources import load_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` anew, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a letter, or mostly in no language, go."""
    return languages.keep_identified(docs, languages.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those left without any line go."""
    removed = unused(docs, "removed_lines")
    cut = lines.remove_repeated_lines(docs, removed=removed)
    emptied = (F.size(removed) > 0) & ~F.col("text").rlike("\\S")
    return _counted(cut.filter(~emptied).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints that link, as in the operator's query."""
    return simhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets made unreadable."""
    return _counted(secrets.redact(docs, secrets.train(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences of at most 2048 tokens."""
    return packed_documents(docs, WORD_TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", packing),
]

# Trained models and a tokeniser take part, so SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet and read again by the next."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
