"""Projection from source articles to fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from article_warehouse.functions import char_count, date_key, text_or_empty, to_long, to_utc, word_count
from article_warehouse.functions.times import BUSINESS_ZONE
from article_warehouse.schemas import FACT_SCHEMA


def transform_articles(articles: DataFrame, zone: str = BUSINESS_ZONE) -> DataFrame:
    """The 14 fact columns, computed row by row in one projection.

    Text measures treat missing text as empty, times that cannot be read become null, and an
    article counts as deleted when its deletion time is known.
    """
    times = {name: to_utc(articles, name) for name in ("published_at", "created_at", "updated_at", "deleted_at")}
    normalised = articles.select(
        F.col("id").cast("string").alias("article_id"),
        to_long(articles, "author_id").alias("author_id"),
        text_or_empty(F.col("title")).alias("title"),
        text_or_empty(F.col("content")).alias("content"),
        *[column.alias(name) for name, column in times.items()],
    )
    derived = {
        "article_key": F.col("article_id"),
        "published_date_key": date_key(F.col("published_at"), zone),
        "created_date_key": date_key(F.col("created_at"), zone),
        "word_count": word_count(F.col("content")),
        "char_count": char_count(F.col("content")),
        "is_deleted": F.col("deleted_at").isNotNull(),
    }
    return normalised.select(*[derived.get(name, F.col(name)).alias(name) for name in FACT_SCHEMA.names])
