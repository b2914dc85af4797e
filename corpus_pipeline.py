"""A training corpus from ``documents``: identify, dedup, near-dedup, mix, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.  ``docs`` may have nulls in any
column, extra columns, repeated rows or no rows at all; the operators'
docstrings say what each then gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm.common import save
from marketlake.llm.exact_dedup import keep_first_copies
from marketlake.llm.langid import keep_identified
from marketlake.llm.mixing import mix
from marketlake.llm.packing import pack
from marketlake.llm.simhash import keep_one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is null or has no letter, so that no language can be identified, go."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (3-word shingles, at most 3 bits apart) one row stays."""
    return keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's target takes it."""
    return mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints and tokens have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
