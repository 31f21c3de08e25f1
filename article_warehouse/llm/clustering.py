"""Centroid clustering over blocks of vectors in the order of a space-filling curve."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from article_warehouse.llm.common import stored
from article_warehouse.llm.vectors import entries_of, finite, matrix

LENGTH, CENTROIDS, ROUNDS, SEED = 64, 40, 5, 2
# Steps for each unit of an entry. Whole numbers up to LARGEST keep a squared distance within 64 bits.
STEPS, LARGEST = 256, 1 << 27
# Up to here products of whole numbers and their sums are exact as floating-point numbers.
EXACT = 1 << 22
# Vectors of a block, and bits of each dimension on the curve.
BLOCK, CURVE_BITS = 128, 4


@dataclass
class Clusters:
    """Centroids by number, with the distances summed over each one's vectors."""

    centroids: np.ndarray
    inertia: list[int]

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def clustered(rows: DataFrame, number: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, length: int = LENGTH) -> DataFrame:
    """One row for each kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``length`` entries, all of them finite; an entry becomes ``floor(STEPS * entry)``. Vectors with one
    beyond ``LARGEST``, whose distances would not be 64-bit numbers, are left out. The first centroids are the vectors whose
    ``seed:vec_id`` has the smallest SHA-256, in this order; a null id counts as the empty text, and rows with one id go by
    their entries. With fewer vectors than ``number`` there are as many centroids; an empty table gives an empty result.
    Repeated rows are rows of their own. Distances and centroids are whole numbers, so results don't depend on the order
    or the partitions of the rows. Ties go to the smaller centroid number.

    An ``inertia`` beyond 64 bits is null.
    """
    entries = entries_of()
    kept = rows.where((F.size(entries) == length) & finite(entries, LARGEST / STEPS))
    points = kept.select("vec_id", F.transform(entries, lambda c: F.floor(c * STEPS)).alias("point"))
    blocks = stored(_blocks(points, length))
    centroids = _first_centroids(points, number, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(blocks, centroids)
    return _assigned(blocks, Clusters(centroids, _inertia(blocks, centroids)), rows.schema["vec_id"].dataType.simpleString())


def _first_centroids(points: DataFrame, number: int, seed: int) -> np.ndarray:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = points.orderBy(F.sha2(name, 256), "point").limit(number).collect()
    return np.array([row.point for row in first], np.int64)


def curve_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``, whole numbers below ``2 ** bits``, as bytes that sort alike.

    Skilling's transform: undo the turns of each level from the finest bits up, then read the Gray code off.
    """
    axes = cells.T.astype(np.int64)
    dims = len(axes)
    for level in range(bits - 1, 0, -1):
        bit = 1 << level
        low = bit - 1
        for i in range(dims):
            turned = (axes[i] & bit) != 0
            swap = np.where(turned, 0, (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(turned, low, swap)
            axes[i] ^= swap
    for i in range(1, dims):
        axes[i] ^= axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    axes ^= flip
    levels = [(axes >> level & 1).astype(np.uint8) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(levels).T, axis=1)


def _blocks(points: DataFrame, length: int) -> DataFrame:
    """Vectors in the order of the curve, ``BLOCK`` of them to a row, with the box around them.

    Sorted by range, with the row's place in the input as last column, so equal vectors are spread as well.
    """

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(length, np.iinfo(np.int64).max), np.full(length, np.iinfo(np.int64).min)
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column(0))
                low, high = np.minimum(low, values.min(axis=0)), np.maximum(high, values.max(axis=0))
        if (low <= high).all():
            columns = [pa.array(range(length), pa.int32()), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "low", "high"])

    spans = points.select("point").mapInArrow(extremes, "place int, low long, high long")
    # One row for each dimension.
    span = sorted(spans.groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    lowest = np.array([row.low for row in span], np.int64)
    width = np.array([row.high - row.low + 1 for row in span], np.int64)

    @F.arrow_udf("binary")
    def place(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.binary())
        cells = (matrix(column) - lowest) * (1 << CURVE_BITS) // width
        return pa.array([key.tobytes() for key in curve_keys(cells, CURVE_BITS)], pa.binary())

    order = ["place", "vec_id", "row"]
    placed = points.select("vec_id", "point", place("point").alias("place"), F.monotonically_increasing_id().alias("row"))
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "point")
    kind = points.schema["vec_id"].dataType.simpleString()

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            column = rows.column(1).combine_chunks()
            values = matrix(column)
            ids = rows.column(0).combine_chunks()
            lists = [pa.ListArray.from_arrays(np.array([0, len(part)], np.int32), part) for part in (ids, column.flatten())]
            boxes = [pa.array([edge]) for edge in (values.min(axis=0), values.max(axis=0))]
            return pa.RecordBatch.from_arrays([*lists, *boxes], ["vec_ids", "points", "low", "high"])

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            full = len(rows) // BLOCK * BLOCK
            for start in range(0, full, BLOCK):
                yield block(rows.slice(start, BLOCK))
            held = rows.slice(full).to_batches()
        if sum(map(len, held)):
            yield block(pa.Table.from_batches(held))

    return ordered.mapInArrow(boxed, f"vec_ids array<{kind}>, points array<long>, low array<long>, high array<long>")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be the nearest of a vector in the box, rising.

    A centroid is out if even the nearest point of the box is farther from it than the farthest point is from another one.
    """
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    across = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((outside**2).sum(axis=1) <= (across**2).sum(axis=1).min())


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and squared distance of the nearest centroid of each vector; ties go to the first."""
    if max(np.abs(values).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        points, ends = values.astype(np.float64), centroids.astype(np.float64)
        distances = (points**2).sum(axis=1)[:, None] - 2 * (points @ ends.T) + (ends**2).sum(axis=1)
        distances = distances.astype(np.int64)
    else:
        distances = np.stack([((values - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(best)), best]


def _assignments(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, cluster and distance of each block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lows, highs = matrix(batch.column(2)), matrix(batch.column(3))
        for i in range(batch.num_rows):
            ids = batch.column(0).slice(i, 1).flatten()
            values = np.asarray(batch.column(1).slice(i, 1).flatten()).reshape(len(ids), -1)
            possible = candidates(lows[i], highs[i], centroids)
            best, distances = nearest(values, centroids[possible])
            yield ids, values, possible[best], distances


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    number, length = centroids.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((number, length + 1), np.int64)
        for _, values, cluster, _ in _assignments(batches, centroids):
            order = np.argsort(cluster, kind="stable")
            found, starts, counts = np.unique(cluster[order], return_index=True, return_counts=True)
            totals[found, :length] += np.add.reduceat(values[order], starts, axis=0)
            totals[found, length] += counts
        cluster, place = np.nonzero(np.broadcast_to(totals[:, length:] > 0, totals.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(totals[cluster, place])],
            ["cluster", "place", "total"],
        )

    parts = blocks.mapInArrow(summed, "cluster int, place int, total long")
    # A row for each dimension of each centroid, and its number of vectors.
    added = parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
    totals = np.zeros((number, length + 1), np.int64)
    for row in added:
        totals[row.cluster, row.place] = row.total
    counts = totals[:, length:]
    return np.where(counts > 0, totals[:, :length] // np.maximum(counts, 1), centroids)


def _inertia(blocks: DataFrame, centroids: np.ndarray) -> list[int]:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * len(centroids)
        for _, _, cluster, distances in _assignments(batches, centroids):
            for c in np.unique(cluster).tolist():
                totals[c] += sum(distances[cluster == c].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(map(str, totals), pa.string())], ["cluster", "total"])

    parts = blocks.mapInArrow(summed, "cluster int, total string")
    added = {row.cluster: int(row.total) for row in parts.groupBy("cluster").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    return [added.get(c, 0) for c in range(len(centroids))]


def _assigned(blocks: DataFrame, clusters: Clusters, kind: str) -> DataFrame:
    digests, total = clusters.digests(), sum(clusters.inertia)
    within = [value if value < 1 << 63 else None for value in clusters.inertia]
    centroids, whole = clusters.centroids, total if total < 1 << 63 else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_cluster, digest_of = pa.array(within, pa.int64()), pa.array(digests, pa.string())
        for ids, _, cluster, distances in _assignments(batches, centroids):
            columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(distances), of_cluster.take(pa.array(cluster))]
            columns += [pa.array([whole] * len(ids), pa.int64()), digest_of.take(pa.array(cluster))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return blocks.mapInArrow(
        rows, f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
