"""Analytical queries over the star schema, from the fact or, with names ending in ``_of_rollup``, from the parts of an
``article_rollup``, which hold a row for each author and day instead of one for each article.

The calendar covers the fact, see ``covering_calendar``; with a row per day of years with four digits it
has 3.7 million rows at most, of which two narrow columns are broadcast. The author dimension grows with
the data: it is joined after the aggregate, and Catalyst chooses how from its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _published(fact: DataFrame, dates: DataFrame, *attributes: str) -> DataFrame:
    """Published articles with calendar attributes, null for days that the calendar lacks; articles without a publication
    date drop out."""
    days = dates.select("date_key", *attributes)
    published = fact.where(F.col("published_date_key").isNotNull())
    return published.join(F.broadcast(days), published["published_date_key"] == days["date_key"], "left")


_ACTIVE = "count_if(is_deleted = false)"


def articles_per_quarter(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Articles and words per year and quarter of publication."""
    return (
        _published(fact, dates, "year", "quarter")
        .groupBy("year", "quarter")
        .agg(F.count(F.lit(1)).alias("articles"), F.sum("word_count").alias("words"))
        .withColumn("mean_words", F.col("words").cast("double") / F.col("articles"))
    )


def active_articles_per_author(fact: DataFrame, authors: DataFrame) -> DataFrame:
    """Active articles and their words per author, next to the author's attributes."""
    per_author = (
        fact.where(F.col("is_deleted") == F.lit(False))
        .groupBy("author_id")
        .agg(F.count(F.lit(1)).alias("active_articles"), F.sum("word_count").alias("active_words"))
    )
    return per_author.join(authors, "author_id").select(
        "author_id", "author_name", "first_article_created_at", "active_articles", "active_words"
    )


def weekend_share_per_author(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Share of each author's articles published on a Saturday or Sunday."""
    return (
        _published(fact.where(F.col("author_id").isNotNull()), dates, "is_weekend")
        .groupBy("author_id")
        .agg(F.count(F.lit(1)).alias("articles"), F.count_if("is_weekend").alias("weekend_articles"))
        .withColumn("weekend_share", F.col("weekend_articles").cast("double") / F.col("articles"))
    )


def articles_per_author_year(fact: DataFrame, dates: DataFrame, authors: DataFrame) -> DataFrame:
    """Articles, active articles and words per author and year of publication."""
    per_year = (
        _published(fact.where(F.col("author_id").isNotNull()), dates, "year")
        .groupBy("author_id", "year")
        .agg(
            F.count(F.lit(1)).alias("articles"),
            F.expr(_ACTIVE).alias("active_articles"),
            F.sum("word_count").alias("words"),
        )
    )
    return (
        per_year.join(authors.select("author_id", "author_name"), "author_id")
        .select("author_id", "author_name", "year", "articles", "active_articles", "words")
        .orderBy("author_id", "year")
    )


def quarters_of_rollup(rollup: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        _published(rollup, dates, "year", "quarter")
        .groupBy("year", "quarter")
        .agg(F.sum("articles").alias("articles"), F.sum("words").alias("words"))
        .withColumn("mean_words", F.col("words").cast("double") / F.col("articles"))
    )


def active_authors_of_rollup(rollup: DataFrame, authors: DataFrame) -> DataFrame:
    per_author = (
        rollup.where("active_articles > 0")
        .groupBy("author_id")
        .agg(F.sum("active_articles").alias("active_articles"), F.sum("active_words").alias("active_words"))
    )
    return per_author.join(authors, "author_id").select(
        "author_id", "author_name", "first_article_created_at", "active_articles", "active_words"
    )


def weekends_of_rollup(rollup: DataFrame, dates: DataFrame) -> DataFrame:
    of_weekend = F.when(F.col("is_weekend"), F.col("articles")).otherwise(0)
    return (
        _published(rollup.where(F.col("author_id").isNotNull()), dates, "is_weekend")
        .groupBy("author_id")
        .agg(F.sum("articles").alias("articles"), F.sum(of_weekend).alias("weekend_articles"))
        .withColumn("weekend_share", F.col("weekend_articles").cast("double") / F.col("articles"))
    )


def author_years_of_rollup(rollup: DataFrame, dates: DataFrame, authors: DataFrame) -> DataFrame:
    per_year = (
        _published(rollup.where(F.col("author_id").isNotNull()), dates, "year")
        .groupBy("author_id", "year")
        .agg(*[F.sum(name).alias(name) for name in ("articles", "active_articles", "words")])
    )
    return (
        per_year.join(authors.select("author_id", "author_name"), "author_id")
        .select("author_id", "author_name", "year", "articles", "active_articles", "words")
        .orderBy("author_id", "year")
    )
