"""A training corpus from raw documents: quality, rules, near duplicates, packing.

Every stage takes the rows that its predecessor kept. All but the last return the columns of
``documents``; the last returns the packed pieces. Lines are judged in context by a classifier
first, because it is one cheap pass and its victims need not be compared with anything; host
rules come next, over what is left; the most expensive step, near duplicates, sees the least.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import line_quality, ngram_join, packing, quality_rules
from panelkit.llm.common import table
from panelkit.llm.queries import vocabulary_file
from panelkit.session import durable, with_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not predict to be bad."""
    return line_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdicts reject."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Every row is judged by its own text, also if it shares its id with others or has none.
    """
    return ngram_join.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, vocabulary_file("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("rules", rules),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

# A fitted classifier and a tokenizer are not SQL; a test holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written as Parquet for the next."""
    with_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
