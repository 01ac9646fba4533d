"""The corpus pipeline: five operators of ``shoplens.llm`` one after another.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
``run`` writes each result as Parquet to the shared folder and reads it again. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from shoplens.llm.tables import written

PASSAGE_WORDS = 50
# 50 words of three letters and a space
PASSAGE_BYTES = 200
PASSAGE_ANCHOR = 32


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.passing_documents(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.distinct_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the row with the smallest doc_id stays."""
    return simhash.representatives(docs, shingle=simhash.SHINGLE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE_WORDS words or more that also stand elsewhere are cut out of the
    texts. They are found by strings of PASSAGE_BYTES bytes, which a passage of so many
    words has even if its words are short; runs with fewer words stay, unless they have
    the operator's own length (scripts without spaces)."""
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES, PASSAGE_ANCHOR, min_words=PASSAGE_WORDS, sure=suffix_dedup.LENGTH)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens, cut to pieces and packed into sequences."""
    return packing.best_fit_pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed_sequences),
]

#: SQL can't express the search of the best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), "pipeline", name.replace(" ", "_"))
    return rows
