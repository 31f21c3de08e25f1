"""Access to the operational ``articles`` table."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from article_warehouse.functions import to_utc
from article_warehouse.operators.keys import key_digests
from article_warehouse.operators.scans import changed_between, created_between, source_ids
from article_warehouse.operators.windows import window_index
from article_warehouse.schemas import ARTICLES_SCHEMA
from article_warehouse.sources.jdbc import JdbcSource


class FrameSource:
    """Articles held in files or in any DataFrame; the scan prunes columns and row groups."""

    # A key occurs once; anything else is a fault.
    on_duplicate = "error"

    def __init__(self, articles: DataFrame):
        self.articles = articles.select(*ARTICLES_SCHEMA.names)

    def rows(self) -> DataFrame:
        return self.articles

    def changed(self, start: datetime, end: datetime) -> DataFrame:
        return changed_between(self.articles, start, end)

    def created(self, start: datetime, end: datetime, days: int) -> DataFrame:
        """All history of the range in one read; file splits bound it, so ``days`` has no effect."""
        return created_between(self.articles, start, end)

    def window_rows(self, start: datetime, end: datetime, days: int) -> dict[int, int]:
        """Number of rows created in each window of ``days`` days that has any."""
        index = window_index(to_utc(self.articles, "created_at"), start, days).alias("window_index")
        counts = created_between(self.articles, start, end).groupBy(index).count()
        return {row["window_index"]: row["count"] for row in counts.collect()}

    def ids(self) -> DataFrame:
        return source_ids(self.articles)

    def id_digests(self) -> DataFrame:
        """Digests per range of the ids of rows that are not deleted, from one aggregate."""
        return key_digests(source_ids(self.articles.where(to_utc(self.articles, "deleted_at").isNull())))

    def ids_within(self, spans: list[tuple[int, int]]) -> DataFrame:
        """The ids; a scan of one column, of which the caller takes what it wants."""
        return self.ids()


def article_source(spark: SparkSession, location: str | None, **options: Any) -> FrameSource | JdbcSource:
    """The articles at a ``jdbc:`` address or at a Parquet path, as exactly the eight source columns."""
    if not location:
        raise ValueError("no source location is configured")
    if location.startswith("jdbc:"):
        return JdbcSource(spark, location, **options)
    return FrameSource(spark.read.parquet(location))
