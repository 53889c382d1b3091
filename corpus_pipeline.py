"""A corpus pipeline: language, exact copies, near copies, repeated passages, packing.

Each stage is a function of (spark, docs, sf_dir) that returns what it keeps of docs; all but the last return the
columns of documents. `run` writes each result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstream.llm.common import emptied, noting_folders, stored
from tripstream.llm.exact_dedup import drop_exact_duplicates
from tripstream.llm.language_id import drop_unidentified
from tripstream.llm.packing import pack
from tripstream.llm.simhash import drop_near_duplicates
from tripstream.llm.suffix_array import drop_repeated_passages


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; those without text or without a letter go."""
    return drop_unidentified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by close fingerprints, the one with the smallest id."""
    return drop_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes or more that one with a smaller id has; n_chars follows the text."""
    return drop_repeated_passages(docs, length_column="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("suffix-array dedup", passages),
    ("packing", packed),
]

#: Encoding and learning can't be expressed in SQL; tests/llm hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each result written and read again.

    Once a stage's result is written, the stage before and all that it derived on the way are emptied, so the shared folder holds two
    stages at a time. What the last stage reads stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        with noting_folders() as folders:
            docs = stored(stage(spark, docs, sf_dir))
        emptied(spark, before + folders[:-1])
        before = folders[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
