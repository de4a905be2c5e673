"""A training-data pipeline over ``documents``: rules, near duplicates,
repeated passages, mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the shared folder and reads it back as the next one's docs.
All but the last return the columns of ``documents``. The results for nulls,
empty and long texts, repeated rows and clashing column names are those of the
operators, each stated in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import bpe, curriculum, line_rules, minhash, repeats
from tillroll.llm.common import read, ship, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines and rejected documents go."""
    ship(spark)
    return line_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    ship(spark)
    return minhash.first_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every repeat of a 100-byte string is cut out."""
    ship(spark)
    return repeats.without_repeats(docs)


def curriculum_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in training order."""
    ship(spark)
    return curriculum.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with their digests."""
    ship(spark)
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing to target weights", curriculum_mix),
    ("byte-level BPE", byte_bpe),
]

#: The last stage's ids aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
