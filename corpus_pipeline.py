"""Training-corpus pipeline: language ID, exact dedup, n-gram near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.  Null and empty texts have no letter and
leave at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkcount.llm import op03_ngram_join as ngram
from sparkcount.llm import op04_block_naming as naming
from sparkcount.llm import op07_language_spans as language
from sparkcount.llm import op09_best_fit as packing
from sparkcount.llm.queries import byte_bpe
from sparkcount.llm.storage import Work
from sparkcount.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that have letters and one language with at least a third of them; the
    model is fitted on the labelled rows of the stage's input."""
    return language.keep_identified(docs, language.fit(docs), min_score=1 / 3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return naming.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a 5-word-shingle Jaccard of 0.8 or more the
    smallest doc_id."""
    return ngram.representatives(docs, k=5, num=80, den=100)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.best_fit_packing(docs, byte_bpe(), end_id=2, capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pack", pack),
]

# Language ID and tokenization cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
