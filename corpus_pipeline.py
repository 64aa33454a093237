"""The document pipeline: language, near copies, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents.  `run` applies them to the documents of a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgrain.llm import languages, overlaps, packing, phrases, pseudonyms
from landgrain.llm.spaces import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

ORACLE_SQL = None
"""Rank-order profiles and connected components have no SQL form; tests use brute force."""


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts that are null or have no letter go.

    Nothing can be learned from a table without labels, and then every document stays.
    """
    profiles = languages.learn(docs.where(~languages.held_out()).select("text", "lang"))
    if not profiles:
        return docs.select(*COLUMNS)
    return languages.identify(docs.select(*COLUMNS), profiles).where("lang_pred <> 'und'").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies: 4/5 of their 5-word shingles in common."""
    return overlaps.one_of_each(docs.select(*COLUMNS))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; n_chars follows."""
    return phrases.without_repeats(docs.select(*COLUMNS))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data; n_chars follows."""
    return pseudonyms.with_pseudonyms(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return packing.pack_texts(docs)


STAGES = [
    ("language", keep_languages),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("private", hide_private),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = new_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
