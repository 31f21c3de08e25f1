"""Checks of the warehouse against its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.operators.calendar import DATE_KEYS, PLAUSIBLE_YEARS, plausible
from article_warehouse.schemas import ARTICLE_KEY


def audit_counts(articles: DataFrame, fact: DataFrame, dates: DataFrame, authors: DataFrame) -> DataFrame:
    """Rows of the source and of each warehouse table, and the number of deleted articles."""

    def counted(df: DataFrame, *measures: tuple[str, Column]) -> DataFrame:
        totals = df.agg(*[column.alias(name) for name, column in measures])
        return totals.unpivot([], [name for name, _ in measures], "check_name", "row_count")

    every = F.count(F.lit(1))
    parts = [
        counted(articles, ("source_rows", every)),
        counted(fact, ("fact_rows", every), ("deleted_rows", F.count_if("is_deleted"))),
        counted(dates, ("date_rows", every)),
        counted(authors, ("author_rows", every)),
    ]
    return reduce(DataFrame.unionByName, parts)


def facts_without_day(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Number of fact rows for each date key that the calendar lacks; none in a sound warehouse."""
    keys = fact.select(F.explode(F.array("published_date_key", "created_date_key")).alias("date_key"))
    counts = keys.where(F.col("date_key").isNotNull()).groupBy("date_key").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(dates, "date_key", "left_anti")


def outlier_days(outliers: DataFrame, years: tuple[int, int] = PLAUSIBLE_YEARS) -> DataFrame:
    """Number of articles for each date key of an implausible year, from the table that holds such articles."""
    keys = outliers.unpivot([ARTICLE_KEY], DATE_KEYS, "date_column", "date_key").where(~plausible(F.col("date_key"), years))
    return keys.groupBy("date_column", "date_key").agg(F.count(F.lit(1)).alias("row_count"))


def source_id_count(ids: DataFrame) -> DataFrame:
    """Number of source ids that a delete reconciliation compares with."""
    return ids.agg(F.count(F.lit(1)).alias("source_ids"))


def article_state(fact: DataFrame, article_id: str) -> DataFrame:
    """Deletion state of one article."""
    return fact.where(F.col(ARTICLE_KEY) == article_id).select(ARTICLE_KEY, "is_deleted", "deleted_at")


def control_records(control: DataFrame) -> DataFrame:
    return control.select("process_name", "state", "watermark", "last_success_at", "details")
