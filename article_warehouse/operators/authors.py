"""Author dimension derived from the fact table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from article_warehouse.functions import instant


def author_dimension(fact: DataFrame, as_of: datetime | str) -> DataFrame:
    """One row per known author with first and last activity and article counts.

    The total includes deleted articles. The active count takes rows whose flag is false,
    so a missing flag counts as neither. Every aggregate has a partial form, so an author
    with a large share of all rows reaches the shuffle as one row per map task.
    """
    counted = (
        fact.where(F.col("author_id").isNotNull())
        .groupBy("author_id")
        .agg(
            F.min("created_at").alias("first_article_created_at"),
            F.max("updated_at").alias("last_article_updated_at"),
            F.count(F.lit(1)).alias("total_article_count"),
            F.count_if(F.col("is_deleted") == F.lit(False)).alias("active_article_count"),
        )
    )
    return author_columns(counted, as_of)


def author_columns(counted: DataFrame, as_of: datetime | str) -> DataFrame:
    """The columns of the dimension from counts per ``author_id``."""
    key = F.col("author_id").cast("string")
    return counted.select(
        "author_id",
        key.alias("author_key"),
        F.concat(F.lit("author_"), key).alias("author_name"),
        "first_article_created_at",
        "last_article_updated_at",
        "total_article_count",
        "active_article_count",
        instant(as_of).alias("updated_at"),
    )
