"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from article_warehouse.scratch import scratch_folder, stored

# Text that one step of a Python function holds in arrays, in bytes; a longer text is held alone.
PIECE_BYTES = 1 << 20


def kept_in_worker(name: str, make: Callable[[], object], most: int = 16):
    """What ``make`` gives, made once in a Python process and found by ``name`` in later tasks too.

    Functions that go to the executors by value don't keep anything from task to task, and those with a cache of their own
    go by name, which needs the package there.
    """
    holder = sys.modules.setdefault("article_warehouse_worker", types.ModuleType("article_warehouse_worker"))
    held = holder.__dict__.setdefault("held", {})
    if name not in held:
        while len(held) >= most:
            held.pop(next(iter(held)))
        held[name] = make()
    return held[name]


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever signs their names have."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]


def id_remainder(modulus: int, name: str = "doc_id") -> Column:
    """Remainder of the CRC of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one."""
    return f"{scratch_folder(spark)}/tables/{uuid.uuid4().hex}"


def kept_table(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have ``most`` rows at most, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of ``texts`` with about ``most`` bytes each, one row at least."""
    sizes = np.concatenate(([0], np.cumsum(text_bytes(texts))))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + most, "right")) - 1)
        yield texts.slice(start, end - start)
        start = end


def text_bytes(texts: pa.Array) -> np.ndarray:
    """UTF-8 length of each text, 0 for null."""
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of ``texts`` one after the other, and where each text begins and the last ends."""
    joined = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = joined.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and len(offsets) else np.zeros(0, np.uint8)
    if not len(offsets):
        return flat[:0], np.zeros(1, np.int64)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_runs(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text between the six ASCII blanks, in runs of about ``most`` bytes."""
    start = 0
    while len(text) - start > most:
        end = start + most
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[start:end].split()
        start = end
    yield text[start:].split()
