"""Articles summed up by author and day of publication, in parts that add up.

A part is made for each partition of the fact and replaced with it, so updates, moves and deletes need no retraction. The
author dimension and the star queries are sums over the parts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from article_warehouse.operators.authors import author_columns

ROLLUP_KEYS = ["author_id", "published_date_key"]


def article_rollup(fact: DataFrame, *partition: str) -> DataFrame:
    """Rows, active rows, words, words of active rows, first creation and last update per author and publication day.

    Articles without an author or a day have rows of their own, so no article is missing. A missing flag is not active.
    """
    active = F.col("is_deleted") == F.lit(False)
    return fact.groupBy(*partition, *ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("articles"),
        F.count_if(active).alias("active_articles"),
        F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.when(active, F.col("word_count"))), F.lit(0)).alias("active_words"),
        F.min("created_at").alias("first_created_at"),
        F.max("updated_at").alias("last_updated_at"),
    )


def merged_rollup(parts: DataFrame) -> DataFrame:
    """One row per author and publication day."""
    sums = [F.sum(name).alias(name) for name in ("articles", "active_articles", "words", "active_words")]
    ends = [F.min("first_created_at").alias("first_created_at"), F.max("last_updated_at").alias("last_updated_at")]
    return parts.groupBy(*ROLLUP_KEYS).agg(*sums, *ends)


def authors_of_rollup(parts: DataFrame, as_of: datetime | str) -> DataFrame:
    """The author dimension, equal to ``author_dimension`` of the fact that the parts were made of."""
    merged = parts.where(F.col("author_id").isNotNull()).groupBy("author_id").agg(
        F.min("first_created_at").alias("first_article_created_at"),
        F.max("last_updated_at").alias("last_article_updated_at"),
        F.sum("articles").alias("total_article_count"),
        F.sum("active_articles").alias("active_article_count"),
    )
    return author_columns(merged, as_of)
