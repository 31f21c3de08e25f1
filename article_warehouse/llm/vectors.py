"""Vectors in tables and in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def entries_of(name: str = "embedding") -> Column:
    return F.col(f"`{name}`").cast("array<double>")


def finite(entries: Column, most: float) -> Column:
    """Whether there is a vector, and all its entries are numbers between ``-most`` and ``most``."""
    return entries.isNotNull() & F.forall(entries, lambda c: F.coalesce((c >= -most) & (c <= most), F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    """One row for each vector of a column of lists, which have one length and no nulls."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def fits(most: int) -> bool:
    """Whether whole numbers up to ``most`` can be added and multiplied as 64-bit numbers."""
    return most < 1 << 62


def moments_of(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight, mean, and centred and multiplied rows of ``values``, as one row of numbers."""
    total = float(weights.sum())
    mean = weights @ values / total
    centred = values - mean
    return np.concatenate([[total], mean, ((centred * weights[:, None]).T @ centred).ravel()])


def merged_moments(parts: Iterable[np.ndarray]) -> np.ndarray | None:
    """Moments of all rows from the moments of parts of them, which are centred before and stay so."""
    merged: np.ndarray | None = None
    for part in parts:
        if merged is None:
            merged = part.copy()
            continue
        size = _width(merged)
        apart, total = part[1 : 1 + size] - merged[1 : 1 + size], merged[0] + part[0]
        merged[1 + size :] += part[1 + size :] + (np.outer(apart, apart) * (merged[0] * part[0] / total)).ravel()
        merged[1 : 1 + size] += apart * (part[0] / total)
        merged[0] = total
    return merged


def moments_batch(parts: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The merged moments of a task as its one row; none if there are no parts."""
    merged = merged_moments(parts)
    if merged is not None:
        yield pa.RecordBatch.from_arrays([pa.array([merged])], ["moments"])


def _width(moments: np.ndarray) -> int:
    return (int(round((4 * len(moments) - 3) ** 0.5)) - 1) // 2


def covariance(parts: DataFrame) -> tuple[float, np.ndarray] | None:
    """Weight and covariance of all rows, from a column ``moments`` that each task has one row of.

    Parts are merged in two levels, so that what arrives in a task or at the driver grows with the square root of the
    number of tasks.
    """
    groups = int(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return moments_batch(row for batch in batches for row in matrix(batch.column(0)))

    if groups > 1:
        dealt = parts.select("moments", (F.spark_partition_id() % groups).alias("part")).repartition(groups, "part")
        parts = dealt.select("moments").mapInArrow(merge, "moments array<double>")
    merged = merged_moments(np.array(row.moments) for row in parts.toLocalIterator())
    if merged is None:
        return None
    size = _width(merged)
    return float(merged[0]), merged[1 + size :].reshape(size, size) / merged[0]
