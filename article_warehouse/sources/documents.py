"""An ``articles`` table derived from the ``documents`` table of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.functions import instant

FIRST_HOUR = "2016-01-01 00:00:00"


def _plus_hours(start: Column, hours: Column) -> Column:
    return start + F.make_dt_interval(F.lit(0), hours.cast("int"))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """One article per document, with creation times spread over ten years; some are to be published ten years later."""
    doc = F.col("doc_id")
    created = _plus_hours(instant(FIRST_HOUR), doc * 7919 % 87600)
    updated = _plus_hours(created, doc % 72)
    author = F.regexp_extract("source", r"(\d+)$", 1).cast("bigint") + 101
    return documents.select(
        (doc + 1).cast("bigint").alias("id"),
        F.concat_ws("-", "lang", "source", doc.cast("string")).alias("title"),
        F.when(doc % 50 != 7, F.col("text")).alias("content"),
        F.when(doc % 11 != 3, _plus_hours(created, F.when(doc % 13 == 4, 87601).otherwise(1))).alias("published_at"),
        F.when(doc % 37 != 5, author).alias("author_id"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(doc % 8 == 0, updated).alias("deleted_at"),
    )
