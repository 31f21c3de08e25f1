"""Bounded time windows over history, totals per window and the batch plan."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from article_warehouse.functions import instant, to_utc, utc_naive
from article_warehouse.operators.scans import created_between
from article_warehouse.scratch import stored


def time_windows(spark: SparkSession, start: datetime | str, end: datetime | str, days: int) -> DataFrame:
    """Half-open windows of ``days`` days that cover ``[start, end)``, the last one cut at the end.

    No rows if the range is empty.
    """
    if days <= 0:
        raise ValueError("days must be positive")
    first, last = utc_naive(start), utc_naive(end)
    count = max(0, -((first - last) // timedelta(days=days)))
    opens = instant(first) + F.make_dt_interval((F.col("id") * days).cast("int"))
    closes = F.least(opens + F.make_dt_interval(F.lit(days)), instant(last))
    return spark.range(count, numPartitions=1).select(
        F.col("id").alias("window_index"), opens.alias("window_start"), closes.alias("window_end")
    )


def window_index(created: Column, start: datetime | str, days: int) -> Column:
    """Number of the window that a UTC time falls in, from elapsed time rather than a range join."""
    return F.floor(F.timestamp_diff("DAY", instant(start), created) / days).cast("bigint")


def window_totals(
    articles: DataFrame, start: datetime | str, end: datetime | str, days: int, batch_size: int
) -> DataFrame:
    """Every window of the range with its row count and the number of batches it takes."""
    counts = (
        created_between(articles, start, end)
        .groupBy(window_index(to_utc(articles, "created_at"), start, days).alias("window_index"))
        .agg(F.count(F.lit(1)).alias("counted"))
    )
    rows = F.coalesce("counted", F.lit(0))
    # Both sides have one row per window.
    return (
        time_windows(articles.sparkSession, start, end, days)
        .join(counts, "window_index", "left")
        .select(
            "window_index",
            "window_start",
            "window_end",
            rows.alias("row_count"),
            F.ceil(rows / batch_size).alias("batch_count"),
        )
    )


def window_groups(
    rows: Mapping[int, int], start: datetime | str, end: datetime | str, days: int, most: int
) -> list[tuple[datetime, datetime]]:
    """``[start, end)`` cut at window borders into adjoining spans of about ``most`` rows, or of a window that has more.

    ``rows`` has the number of rows of each window that has any.
    """
    start, end = utc_naive(start), utc_naive(end)
    cuts, held = [start], 0
    for index in sorted(rows):
        opens = start + timedelta(days=days * index)
        if held and held + rows[index] > most and cuts[-1] < opens < end:
            cuts.append(opens)
            held = 0
        held += rows[index]
    return list(zip(cuts, [*cuts[1:], end], strict=True)) if start < end else []


def batch_plan(
    articles: DataFrame, start: datetime | str, end: datetime | str, days: int, batch_size: int
) -> DataFrame:
    """The batch of its window that each row falls in, in ``(created_at, id)`` order.

    A plain row number per window would sort a whole window in one task. Here the rows are
    range-sorted across all tasks, each row gets its position within its task, and the number
    of rows that earlier tasks hold of the same window is added from a table with at most one
    row per task and window. Rows that share one creation time are split by id.
    """
    created = to_utc(articles, "created_at")
    keys = created_between(articles, start, end).select(
        F.col("id"), created.alias("created_at"), window_index(created, start, days).alias("window_index")
    )
    sorted_keys = keys.repartitionByRange("created_at", "id").sortWithinPartitions("created_at", "id")
    # The upper bits number the task and the lower 33 bits the row within it. Range bounds come
    # from a sample, so the numbering is stored once and both uses below read the same one.
    numbered = stored(sorted_keys.withColumn("position", F.monotonically_increasing_id())).withColumn(
        "slice", F.shiftright("position", 33)
    )
    slices = numbered.groupBy("window_index", "slice").agg(
        F.count(F.lit(1)).alias("held"), F.min("position").alias("first_position")
    )
    earlier = Window.partitionBy("window_index").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "window_index",
        "slice",
        (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first_position")).alias("shift"),
    )
    row_index = F.col("position") + F.col("shift")
    return numbered.join(offsets, ["window_index", "slice"]).select(
        "id", "created_at", "window_index", F.floor(row_index / batch_size).cast("bigint").alias("batch_index")
    )
