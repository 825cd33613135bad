"""From raw documents to a training mixture, stage by stage.

Each stage takes the documents that the one before it kept, written as Parquet and read again, and returns
documents with the same columns; the last adds how many epochs of each are in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.llm.decontaminate import drop_contaminated
from skyload.llm.langid import keep_identified
from skyload.llm.lineruns import drop_repeated_runs, without_emptied
from skyload.llm.neardup import keep_one_of_each
from skyload.llm.queries import mixture, read
from skyload.llm.texts import free_name
from skyload.session import release, stable


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and those whose language cannot be told."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs, and documents of which no word is left; ``n_chars`` follows the text."""
    deleted = F.col(free_name(docs, "n_deleted"))
    cleaned = without_emptied(drop_repeated_runs(docs), deleted)
    chars = F.when(deleted > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")
    return cleaned.select(*[chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share ten words in a row with a benchmark item."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Select documents by the weights of domains, languages and sources."""
    return mixture(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# Learned models and hashed signatures have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, stable(stage(spark, docs, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
