"""Exact duplicates by a 128-bit content hash, with the bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.llm.common import columns_of, small, stored, text_of

# Keys up to this number are broadcast after they were counted: 16 bytes each, 32 MB as rows in memory.
BROADCAST_KEYS = 250_000


def normalised(text: Column) -> Column:
    """Each run of ASCII blanks as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def content_hash(sha256: Column) -> Column:
    """The first 128 bits of a SHA-256 in hexadecimal."""
    return F.unhex(F.substring(sha256, 1, 32))


def exact_groups(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document with the group of equal texts that it belongs to.

    Texts are equal if they are identical after ``normalised``; null counts as empty. Columns:
    doc_id, keep_id (smallest id of the group), group_size, kept, text_sha256. Exactly one row of a
    group is kept, also where several rows have the smallest id; a null id is kept only in a group
    without other ids. Rows are never compared in pairs: groups form by a hash, and each group of
    more than one row is aggregated again by its texts, which tells apart texts with one hash.
    ``hashed`` makes the group key from the SHA-256.
    """
    return _grouped(docs, hashed).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The row that stays of each group of equal texts, with all columns of ``docs``.

    Dropped rows are named by id and content key. Rows that share both with the row that stays, that
    is repeated rows, are put together again from the table; which one of them stays is open.
    """
    same_id = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    dropped = stored(_grouped(docs, content_hash).where(~F.col("kept")).select("doc_id", "content_key", same_id.alias("same_id")))
    names = dropped.select(F.struct("doc_id", "content_key").alias("content_name")).distinct()
    content_key = content_hash(F.sha2(normalised(text_of()), 256))
    named = docs.select(F.struct(*columns_of(docs)).alias("row"), F.struct("doc_id", content_key.alias("content_key")).alias("content_name"))
    kept = named.join(small(names, BROADCAST_KEYS), "content_name", "left_anti").select("row.*")
    repeated = dropped.where("same_id").select(F.struct("doc_id", "content_key").alias("content_name")).distinct()
    if repeated.isEmpty():
        return kept
    one_each = named.join(repeated, "content_name", "left_semi").groupBy("content_name").agg(F.first("row").alias("row"))
    return kept.unionByName(one_each.select("row.*"))


def _grouped(docs: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    rows = stored(_hashed_rows(docs, hashed).drop("content"))
    repeated = stored(_groups(rows, "content_key").where("group_size > 1"))
    classes = (
        _matching(_hashed_rows(docs, hashed).select("content_key", "content"), repeated)
        .groupBy("content_key", "content")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    collided = stored(classes.groupBy("content_key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"))
    if collided.isEmpty():
        return _result(rows.join(repeated, "content_key", "left"))
    # Texts that share a hash: their groups form by the text itself.
    apart = stored(_matching(_hashed_rows(docs, hashed), collided))
    by_text = stored(_groups(apart, "content_key", "content"))
    others = rows.join(collided, "content_key", "left_anti").join(repeated, "content_key", "left")
    return _result(others).unionByName(_result(apart.join(by_text, ["content_key", "content"], "left")))


def _hashed_rows(docs: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    content = docs.select("doc_id", normalised(text_of()).alias("content"))
    return content.select(
        "doc_id", "content", F.sha2("content", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row_id")
    ).withColumn("content_key", hashed(F.col("text_sha256")))


def _groups(rows: DataFrame, *key: str) -> DataFrame:
    first_row = F.coalesce(F.min_by("row_id", "doc_id"), F.min("row_id"))
    return rows.groupBy(*key).agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), first_row.alias("keep_row")
    )


def _matching(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose content key is among ``keys``."""
    keys = keys.select("content_key")
    return rows.join(small(keys, BROADCAST_KEYS), "content_key", "left_semi")


def _result(found: DataFrame) -> DataFrame:
    alone = F.col("keep_row").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
        "content_key",
    )

