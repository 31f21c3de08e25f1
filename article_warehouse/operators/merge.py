"""Keyed upsert, delete reconciliation and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, functions as F

from article_warehouse.functions import instant
from article_warehouse.schemas import ARTICLE_KEY


class DuplicateKeyError(ValueError):
    """A merge batch holds more than one row for a key."""


# Keys are short texts; this many take about 100 MB in a broadcast table.
BROADCAST_KEYS = 1_000_000


def sized_keys(keys: DataFrame, count: int) -> DataFrame:
    """Keys whose number was counted, marked for broadcast if they are few enough.

    Joined with many keys, both sides are shuffled as usual.
    """
    return F.broadcast(keys) if count <= BROADCAST_KEYS else keys


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str = ARTICLE_KEY,
    keep: Sequence[str] = (),
    batch_rows: int | None = None,
) -> DataFrame:
    """``target`` after overwriting matched rows with those of ``batch`` and adding the others.

    The batch wins whatever its times say, and nothing is deleted. Columns that the batch lacks,
    and those named in ``keep``, hold on to the value of a matched row. ``article_key`` equals
    the key, so it needs no keeping. ``batch`` must have one row per key. With a known, small
    number of ``batch_rows`` the target is not shuffled.
    """
    kept = [name for name in target.columns if name in keep or name not in batch.columns]
    if kept:
        # Only the key and the kept columns of the target take part in this join.
        old = target.select(key, *[F.col(name).alias(f"old_{name}") for name in kept], F.lit(True).alias("matched"))
        values = {
            name: F.when(F.col("matched"), F.col(f"old_{name}")).otherwise(
                F.col(name) if name in batch.columns else F.lit(None)
            )
            for name in kept
        }
        batch = batch.join(old, key, "left").select(
            *[values.get(name, F.col(name)).alias(name) for name in target.columns]
        )
    keys = batch.select(key)
    if batch_rows is not None:
        keys = sized_keys(keys, batch_rows)
    untouched = target.join(keys, key, "left_anti").select(target.columns)
    return untouched.unionByName(batch.select(target.columns))


def missing_from_source(fact: DataFrame, ids: DataFrame, key: str = ARTICLE_KEY) -> DataFrame:
    """Active fact rows whose key is not among the source ids."""
    return fact.where(_active()).join(ids.select(key), key, "left_anti")


def reconcile_deletes(
    fact: DataFrame,
    ids: DataFrame,
    as_of: datetime | str,
    key: str = ARTICLE_KEY,
    missing_rows: int | None = None,
) -> DataFrame:
    """``fact`` with active rows that are gone from the source marked as deleted.

    Rows already marked, rows without a flag and ids unknown to the fact change nothing. Keys and flags alone
    are compared with the ids. With a known, small number of ``missing_rows`` the full rows are not shuffled.
    """
    missing = missing_from_source(fact.select(key, "is_deleted"), ids, key).select(key).distinct()
    if missing_rows is not None:
        missing = sized_keys(missing, missing_rows)
    rows = fact.join(missing.withColumn("missing", F.lit(True)), key, "left")
    return mark_deleted(rows, F.col("missing") & _active(), as_of).select(fact.columns)


def mark_deleted(fact: DataFrame, gone: Column, as_of: datetime | str) -> DataFrame:
    """``fact`` with rows where ``gone`` holds turned into deleted ones; a known deletion time stays."""
    now = instant(as_of)
    changes = {
        "is_deleted": F.lit(True),
        "deleted_at": F.coalesce("deleted_at", now),
        "updated_at": now,
    }
    return fact.withColumns({name: F.when(gone, new).otherwise(F.col(name)) for name, new in changes.items()})


def _active() -> Column:
    # A missing flag is neither active nor deleted.
    return F.col("is_deleted") == F.lit(False)


def row_fingerprint(columns: Sequence[str]) -> Column:
    """A 64-bit hash of a row's values and the names they stand under; a column that is null counts as absent."""
    named = [value for name in sorted(columns) for value in (F.when(F.col(f"`{name}`").isNotNull(), F.lit(name)), F.col(f"`{name}`"))]
    return F.xxhash64(*named)


def duplicate_keys(batch: DataFrame, key: str = ARTICLE_KEY) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def key_profile(batch: DataFrame, key: str = ARTICLE_KEY) -> Row:
    """Numbers of rows, distinct keys, repeated keys and rows without a key, from one pass over the keys."""
    rows, known = F.col("row_count"), F.col(key).isNotNull()
    return (
        batch.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
            F.count_if(known).alias("key_count"),
            F.count_if(known & (rows > 1)).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(~known, rows)), F.lit(0)).alias("without_key"),
        )
        .first()
    )


def require_unique(batch: DataFrame, key: str = ARTICLE_KEY) -> None:
    """Fail if a key occurs more than once, naming a few of them."""
    examples = duplicate_keys(batch, key).limit(5).collect()
    if examples:
        named = ", ".join(f"{row[key]} ({row['row_count']} rows)" for row in examples)
        raise DuplicateKeyError(f"repeated {key}: {named}")


def keep_latest(
    batch: DataFrame, key: str = ARTICLE_KEY, order: str = "updated_at", repeated: tuple[DataFrame, int] | None = None
) -> DataFrame:
    """One row per key: the one with the highest ``order``, then the highest remaining columns.

    The aggregate has a partial form, so a key with a large share of all rows is reduced to one
    row per map task before the shuffle. With the ``repeated`` keys, all of them, and their number,
    only rows of these keys are aggregated, and the others stay where they are.
    """
    if repeated is not None:
        keys = sized_keys(repeated[0].select(key), repeated[1])
        latest = keep_latest(batch.join(keys, key, "left_semi"), key, order)
        return batch.join(keys, key, "left_anti").select(batch.columns).unionByName(latest.select(batch.columns))
    rest = [name for name in batch.columns if name not in (key, order)]
    return (
        batch.groupBy(key)
        .agg(F.max(F.struct(order, *rest)).alias("latest"))
        .select(*[F.col(name if name == key else f"latest.{name}").alias(name) for name in batch.columns])
    )
