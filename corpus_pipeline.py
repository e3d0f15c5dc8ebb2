"""The corpus pipeline: documents through five of the corpus operators.

Each stage works on all rows that the one before has kept; all but the last return the
columns of ``documents``.  Rows with nulls, empty texts, repeated ids and further columns
pass as the operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm.common import table, work_folder, written
from footfall.llm.decontamination import drop_leaking
from footfall.llm.mixing import mixed_documents
from footfall.llm.ngrams import keep_one
from footfall.llm.quality import keep_good
from footfall.llm.store import token_file_rows


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, learned from ``labels``, rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that every source has the same share."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids go to files; a row for each document as it is read back from them."""
    return token_file_rows(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_files),
]

#: A compression classifier and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before has written to the shared folder."""
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark, "pipeline")
    for place, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{place}")
    return docs
