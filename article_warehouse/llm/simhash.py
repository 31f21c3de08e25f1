"""Near-duplicates by SimHash fingerprints, compared as bit planes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from article_warehouse.llm.common import columns_of, pieces, small, stored, text_of, word_runs
from article_warehouse.llm.components import connected_components

# Seed of the shingle hash. Fixed value.
HASH_SEED = 42
# Fingerprints of a bucket that one comparison holds; larger buckets are cut into slices.
SLICE = 2048
# Fingerprints that a bucket should have on average at most, which sets the number of key bits.
BUCKET = 512
# Pairs of a fingerprint and a block of 64 that are compared at a time.
UNITS = 1 << 15

_FIRST_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = 3) -> bytes:
    """SimHash of the word shingles of a text in UTF-8, 8 bytes with the highest bit first.

    A-Z count as lower case. A text with fewer words than a shingle is one shingle; without words the
    fingerprint is zero. A bit is set if more than half of the shingles, repeats included, have it.
    """
    counts, total, carried = np.zeros((8, 256), np.int64), 0, []
    digest = xxhash.xxh64_digest
    for run in word_runs(text.lower()):
        words = carried + run
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = [0, *ends[:-shingle].tolist()]
            cut = [joined[i:j] for i, j in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
            hashes = np.frombuffer(b"".join(map(digest, cut, repeat(HASH_SEED))), np.uint8).reshape(-1, 8)
            places = hashes + np.arange(0, 2048, 256)
            counts += np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
            total += len(hashes)
            carried = words[len(words) - shingle + 1 :]
        else:
            carried = words
    if not total:
        return digest(b" ".join(carried), HASH_SEED) if carried else bytes(8)
    return np.packbits(2 * (counts @ _FIRST_BIT) > total).tobytes()


def fingerprint_udf(shingle: int):
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = bytearray()
        for piece in pieces(texts):
            for text in piece.cast(pa.binary()):
                found += fingerprint(text.as_buffer().to_pybytes() if text.is_valid else b"", shingle)
        return pa.array(np.frombuffer(bytes(found), ">i8").astype(np.int64))

    return fingerprints


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Documents whose fingerprints differ in ``radius`` bits at most are linked; ``component_id`` is the
    smallest id that links reach, null only if all ids of the component are null. All links are found:
    of m parts of the 64 bits, m - radius are equal in two linked fingerprints. Null and empty texts
    have the fingerprint zero, which links like any other.
    """
    rows = stored(docs.select("doc_id", fingerprint_udf(shingle)(text_of()).alias("fingerprint")))
    return _classified(rows, radius).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _classified(rows: DataFrame, radius: int) -> DataFrame:
    """``rows`` (doc_id, fingerprint and others) with their component_id."""
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    members = stored(connected_components(linked_fingerprints(distinct.select("fingerprint"), radius)))
    least = (
        members.join(distinct, members["node"] == distinct["fingerprint"])
        .groupBy("root")
        .agg(F.min("least_id").alias("component_id"))
    )
    of_node = members.join(stored(least), "root").select(F.col("node").alias("fingerprint"), "component_id", "root")
    by_print = distinct.join(of_node, "fingerprint", "left").select(
        "fingerprint",
        F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("root", "fingerprint").alias("root"),
    )
    return rows.join(stored(by_print), "fingerprint")


def linked_fingerprints(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between the fingerprints of ``distinct`` within ``radius`` bits.

    They connect what all links connect: a comparison returns a spanning forest of the links that it found.
    """
    count = distinct.count()
    parts = radius + 1
    while count > BUCKET * 2 ** (64 * (parts - radius) // parts) and parts < 2 * radius + 2:
        parts += 1
    bounds = [64 * i // parts for i in range(parts + 1)]
    masks = []
    for kept in combinations(range(parts), parts - radius):
        mask = sum(((1 << (bounds[i + 1] - bounds[i])) - 1) << bounds[i] for i in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keyed = distinct.select(
        "fingerprint", F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.lit(m).alias("mask")) for i, m in enumerate(masks)])).alias("part")
    ).select("fingerprint", F.col("part.which").alias("which"), F.col("fingerprint").bitwiseAND(F.col("part.mask")).alias("value"))
    keyed = stored(keyed)
    sizes = stored(keyed.groupBy("which", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    slices = F.ceil(F.col("members") / SLICE).cast("int")
    shared = keyed.join(sizes, ["which", "value"]).withColumn("slices", slices)
    own = F.pmod(F.xxhash64("fingerprint"), F.col("slices")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    placed = shared.select("*", own.alias("own")).select("*", each).select(
        "which", "value", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "fingerprint"
    )
    key = ["which", "value", "first", "second"]
    parts_needed = max(1, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartition(parts_needed, *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(_compare_groups(radius), "a long, b long").distinct()


def _compare_groups(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(6)], axis=1)
            held.append(rows)
            rows = np.concatenate(held)
            # Whole groups only; the last one may go on in the next batch.
            starts = _group_starts(rows)
            if len(starts) > 1:
                yield _edges(rows[: starts[-1]], radius)
                rows = rows[starts[-1] :]
            held = [rows]
        if held and len(held[0]):
            yield _edges(held[0], radius)

    return compare


def _group_starts(rows: np.ndarray) -> np.ndarray:
    if not len(rows):
        return np.zeros(0, np.int64)
    changed = (rows[1:, :4] != rows[:-1, :4]).any(axis=1)
    return np.concatenate(([0], np.flatnonzero(changed) + 1))


def _edges(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    """Spanning forests of the links in each group of ``rows`` (which, value, first, second, own, fingerprint)."""
    starts = _group_starts(rows)
    sizes = np.diff(np.append(starts, len(rows)))
    labels = np.arange(len(rows))
    prints = rows[:, 5].view(np.uint64)
    # Blocks of 64 fingerprints, of the second slice where a group has two.
    group = np.repeat(np.arange(len(starts)), sizes)
    crossed = rows[:, 2] != rows[:, 3]
    member = np.flatnonzero(~crossed | (rows[:, 4] == rows[:, 3]))
    asking = np.flatnonzero(~crossed | (rows[:, 4] == rows[:, 2]))
    counts = np.bincount(group[member], minlength=len(starts))
    blocks = -(-counts // 64)
    first_block = np.concatenate(([0], np.cumsum(blocks)))
    place = np.arange(len(member)) - np.repeat(np.cumsum(counts) - counts, counts)
    slot = (first_block[group[member]] + place // 64) * 64 + place % 64
    held_by = np.full(first_block[-1] * 64, -1, np.int64)
    held_by[slot] = member
    per_asking = blocks[group[asking]]
    done = np.cumsum(per_asking)
    start = 0
    while start < len(asking):
        end = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + UNITS, "right")))
        chosen = asking[start:end]
        times = per_asking[start:end]
        row = np.repeat(chosen, times)
        block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + first_block[group[row]]
        a, b = _near(prints, row, block, held_by, radius)
        _unite(labels, a, b)
        start = end
    moved = np.flatnonzero(labels != np.arange(len(rows)))
    return pa.RecordBatch.from_arrays([pa.array(rows[moved, 5]), pa.array(rows[labels[moved], 5])], ["a", "b"])


def _near(prints: np.ndarray, row: np.ndarray, block: np.ndarray, held_by: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows within ``radius``, from comparing each ``row`` with the 64 fingerprints of its ``block``.

    Bit planes hold one bit of 64 fingerprints in a word. Differences are added plane by plane into
    counters that are stored as bit planes too; a block is left out once all its counters are over the radius.
    """
    used, place = np.unique(block, return_inverse=True)
    slots = (used[:, None] * 64 + np.arange(64)).ravel()
    holder = held_by[slots].reshape(-1, 64)
    values = np.where(holder >= 0, prints[np.maximum(holder, 0)], np.uint64(0)).astype(">u8")
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 64, 8), axis=2)
    planes = np.packbits(np.ascontiguousarray(bits.transpose(0, 2, 1)), axis=2).view(">u8").reshape(-1, 64).astype(np.uint64)
    valid = np.packbits(holder >= 0, axis=1).view(">u8").ravel().astype(np.uint64)
    alive, own = np.arange(len(row)), prints[row]
    over = ~valid[place]
    width = max(1, radius.bit_length())
    counters = np.zeros((width, len(row)), np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for bit in range(64):
        mine = (own[alive] >> np.uint64(63 - bit)) & np.uint64(1)
        carry = planes[place[alive], bit] ^ (np.uint64(0) - mine)
        for level in range(width):
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        over |= carry
        if bit % 4 == 3:
            going = over != full
            if not going.all():
                alive, over, counters = alive[going], over[going], counters[:, going]
            if not len(alive):
                break
    # Counters hold distances up to 2 ** width - 1; those over the radius are ruled out here.
    for value in range(radius + 1, 1 << width):
        equal = np.full(len(alive), full)
        for level in range(width):
            equal &= counters[level] if value >> level & 1 else ~counters[level]
        over |= equal
    hits = np.unpackbits((~over).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    unit, column = np.nonzero(hits)
    a, b = row[alive[unit]], holder[place[alive[unit]], column]
    return a[a != b], b[a != b]


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives the rows that pairs connect one label, the smallest row."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels[:] = shorter


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns of ``docs``.

    Rows with a null or repeated id are told apart by their fingerprint; if several rows of a component
    have its smallest id, one of them stays, and which is open.
    """
    rows = stored(docs.select("doc_id", fingerprint_udf(shingle)(text_of()).alias("fingerprint")))
    found = stored(_classified(rows, radius))
    unclear = stored(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or doc_id is null"))
    dropped = found.where("doc_id <> component_id").select("doc_id")
    names = stored(dropped.unionByName(unclear.where("doc_id is not null").select("doc_id")).distinct())
    kept = docs.where("doc_id is not null").join(small(names, 250_000), "doc_id", "left_anti").select(*columns_of(docs))
    if unclear.isEmpty():
        return kept
    ids = small(unclear.select(F.struct("doc_id").alias("of")), 250_000)
    again = docs.select(F.struct(*columns_of(docs)).alias("row")).join(ids, F.struct("row.doc_id") == F.col("of"), "left_semi")
    printed = again.select("row", fingerprint_udf(shingle)(text_of("row.text")).alias("fingerprint"))
    classes = found.select("fingerprint", "component_id", "root").distinct()
    stays = printed.join(classes, "fingerprint").where(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    return kept.unionByName(stays.groupBy("root").agg(F.first("row").alias("row")).select("row.*"))
