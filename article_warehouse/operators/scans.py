"""Source scans: changed rows, history ranges, pages and ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from article_warehouse.functions import instant, to_utc
from article_warehouse.schemas import ARTICLE_KEY


def _half_open(df: DataFrame, name: str, start: datetime | str, end: datetime | str) -> Column:
    """``start <= df[name] < end``, on the raw column so that the scan can evaluate it."""
    kind = df.schema[name].dataType
    column = to_utc(df, name) if isinstance(kind, T.StringType) else F.col(name)
    return (column >= instant(start, kind)) & (column < instant(end, kind))


def changed_between(
    articles: DataFrame, start: datetime | str, end: datetime | str, ordered: bool = False
) -> DataFrame:
    """Rows with ``updated_at`` in ``[start, end)``.

    A load does not depend on the order, so sorting by ``(updated_at, id)`` is for display only.
    """
    rows = articles.where(_half_open(articles, "updated_at", start, end))
    return rows.orderBy("updated_at", "id") if ordered else rows


def created_between(articles: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows with ``created_at`` in ``[start, end)``."""
    return articles.where(_half_open(articles, "created_at", start, end))


def keyset_page(
    articles: DataFrame,
    start: datetime | str,
    end: datetime | str,
    size: int,
    after: tuple[datetime | str, int] | None = None,
) -> DataFrame:
    """The next ``size`` rows of ``[start, end)`` in ``(created_at, id)`` order after a cursor."""
    page = created_between(articles, start, end)
    if after is not None:
        kind = articles.schema["created_at"].dataType
        time, last_id = instant(after[0], kind), F.lit(after[1])
        created = F.col("created_at")
        # The first term is implied by the second and is one the scan can evaluate.
        page = page.where(created >= time).where((created > time) | (F.col("id") > last_id))
    return page.orderBy("created_at", "id").limit(size)


def source_ids(articles: DataFrame) -> DataFrame:
    """Every source id as text, reading no other column."""
    return articles.select(F.col("id").cast("string").alias(ARTICLE_KEY))
