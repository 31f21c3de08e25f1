"""The corpus pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from article_warehouse.files import delete_folder
from article_warehouse.llm.common import kept_table, new_folder, table
from article_warehouse.llm.decontaminate import drop_contaminated
from article_warehouse.llm.exact import drop_exact_duplicates
from article_warehouse.llm.mixing import mix
from article_warehouse.llm.quality import keep_quality
from article_warehouse.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; a null text is scored as an empty one."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of equal texts stays; null and empty texts are equal."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id; texts without words are one group."""
    return drop_near_duplicates(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document left is taken: the rows of ``mix``, one for each document; none of an empty table."""
    return mix(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of what the stages keep of ``documents``.

    Each stage's result is a Parquet table in the shared folder. They are deleted at the end, also of a run that
    fails: the mix rests on what it has stored itself.
    """
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark)
    try:
        for number, (_, stage) in enumerate(STAGES[:-1]):
            docs = kept_table(stage(spark, docs, sf_dir), f"{folder}/{number}")
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        delete_folder(spark, folder)
