"""Whitening of embeddings by a covariance over distinct vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from article_warehouse.llm.common import stored
from article_warehouse.llm.vectors import covariance, entries_of, finite, fits, matrix, moments_batch, moments_of

COMPONENTS = 16
# Steps of the grid for each unit of an entry, and what is added so that usual numbers are positive.
STEPS, OFFSET = 64, 1_000_000
# Entries beyond this have no 64-bit number on the grid.
LARGEST = float(1 << 56)
# A vector with more than this share of all rows is joined back by broadcast; there can be 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000
# An eigenvalue below this part of the largest is rounding, not spread.
RANK = 1e-10


def whitened(rows: DataFrame, weighted: bool = False, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors become whole numbers ``floor(STEPS * entry) + OFFSET``; the covariance is over the distinct ones, each with
    weight one or, if ``weighted``, with the number of its rows. ``n`` is their weight. Components count from 1 by falling
    eigenvalue; their sign makes the entry that is largest in size positive. Rows are whitened once for each distinct vector.

    Left out are null vectors, those with null, non-finite or larger entries than ``LARGEST``, and those of another length
    than most vectors (the longer one of lengths with as many). Repeated rows and null ids are rows of their own.
    Components without spread are none, so rows of a single distinct vector give no result, and an empty table none.
    ``deviation`` is null where it is larger than a 64-bit number.
    """
    entries = entries_of()
    usable = rows.where(finite(entries, LARGEST)).select("vec_id", entries.alias("entries"))
    length = usable.groupBy(F.size("entries").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    size = length["length"] if length else 0
    on_grid = F.transform("entries", lambda c: F.floor(c * STEPS) + OFFSET)
    vectors = usable.where(F.size("entries") == size).select("vec_id", on_grid.alias("x"))
    distinct = stored(vectors.groupBy("x").agg(F.count(F.lit(1)).alias("copies")))
    totals = distinct.agg(F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    n = totals["rows"] if weighted else totals["distinct"]
    sums = _sums(distinct, size, weighted)
    found = covariance(distinct.mapInArrow(_centred_moments(n, sums, weighted), "moments array<double>")) if n and size else None
    values, axes = _components(found[1] if found else np.zeros((0, 0)), components)
    once = stored(distinct.mapInArrow(_projection(n, sums, values, axes), "x array<long>, copies long, deviation long, whitened array<double>"))
    error = _identity_error(once, weighted) if len(values) else 0.0
    trace = float(np.trace(found[1])) if found else 1.0
    back = _joined_back(vectors, once, totals["rows"])
    each = back.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(float(e / trace)) for e in values]).cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _weights(batch: pa.RecordBatch, weighted: bool) -> np.ndarray:
    copies = np.asarray(batch.column(1))
    return copies if weighted else np.ones(len(copies), np.int64)


def _sums(distinct: DataFrame, size: int, weighted: bool) -> list[int]:
    """Weighted sum of each dimension, exact."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * size
        for batch in batches:
            if not batch.num_rows:
                continue
            x, weights = matrix(batch.column(0)), _weights(batch, weighted)
            if not fits(int(np.abs(x).max(initial=0)) * int(weights.sum())):
                x, weights = x.astype(object), weights.astype(object)
            total = [a + int(b) for a, b in zip(total, (x * weights[:, None]).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(map(str, total), pa.string())], ["place", "total"])

    parts = distinct.mapInArrow(summed, "place int, total string")
    # One row for each dimension.
    added = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return [int(row.total) for row in sorted(added, key=lambda row: row.place)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers if they suffice, else whole numbers of any size."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    kind = np.int64 if fits(most) else object
    return x.astype(kind) * n - np.array(sums, kind)


def _centred_moments(n: int, sums: list[int], weighted: bool):
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            centred = (_deviations(matrix(batch.column(0)), n, sums) / n).astype(np.float64)
            return moments_of(centred, _weights(batch, weighted).astype(np.float64))

        return moments_batch(part(batch) for batch in batches if batch.num_rows)

    return moments


def _components(spread: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, and a column with the unit eigenvector of each."""
    if not len(spread):
        return np.zeros(0), np.zeros((0, 0))
    values, axes = np.linalg.eigh(spread)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    real = values > RANK * max(values[0], 0.0)
    values, axes = values[real], axes[:, real]
    return values, axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)


def _projection(n: int, sums: list[int], values: np.ndarray, axes: np.ndarray):
    scaled = axes / np.sqrt(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not (batch.num_rows and len(values)):
                continue
            apart = _deviations(matrix(batch.column(0)), n, sums)
            found = (apart / n).astype(np.float64) @ scaled
            if apart.dtype == object or not fits(int(np.abs(apart).max()) ** 2 * apart.shape[1]):
                squares = [int(s) for s in (apart.astype(object) ** 2).sum(axis=1)]
                deviation = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
            else:
                deviation = pa.array((apart**2).sum(axis=1))
            lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, len(values), dtype=np.int32), found.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], deviation, lists], ["x", "copies", "deviation", "whitened"])

    return project


def _identity_error(once: DataFrame, weighted: bool) -> float:
    """Largest difference between the covariance of whitened vectors and the identity."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (batch for batch in batches if batch.num_rows)
        return moments_batch(moments_of(matrix(b.column(0)), _weights(b, weighted).astype(np.float64)) for b in filled)

    spread = covariance(once.select("whitened", "copies").mapInArrow(moments, "moments array<double>"))[1]
    return float(np.abs(spread - np.eye(len(spread))).max())


def _joined_back(vectors: DataFrame, once: DataFrame, rows: int) -> DataFrame:
    """Each row with what its distinct vector has; vectors with a large share of all rows aren't shuffled."""
    hot = F.col("copies") > HOT_SHARE * rows
    large, others = once.where(hot).drop("copies"), once.where(~hot).drop("copies")
    rest = vectors.join(F.broadcast(large.select("x")), "x", "left_anti")
    return vectors.join(F.broadcast(large), "x").unionByName(rest.join(others, "x"))
