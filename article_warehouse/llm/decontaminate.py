"""Benchmark items inside documents, by MinHash containment search over items partitioned by size."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.llm.common import columns_of, flat_bytes, pieces, small, stored, text_of
from article_warehouse.llm.words import WORD_BYTE, hashed_shingles, hashed_words

# Words of a shingle, and the share of an item's shingles that a document must have.
SHINGLE, THRESHOLD = 5, 0.8
# Bytes of items that are sent to all executors; the sketches of a larger benchmark are joined.
BLOCK_BYTES = 8 << 20
# Bits for each sketch hash of a filter that goes to all executors, and the most that it has (128 MB).
FILTER_BITS, FILTER_MOST = 16, 1 << 30


@dataclass(frozen=True)
class SizeClass:
    """Items of one shingle length and one range of sizes, with the sketches of all of them.

    ``hashes`` are sorted, ``items`` says of which item each is. A document with fewer than ``least``
    shingles cannot match.
    """

    length: int
    least: int
    hashes: np.ndarray
    items: np.ndarray
    bitmap: np.ndarray


def item_shingles(words: list[bytes]) -> tuple[int, set[bytes]]:
    """Shingle length and distinct shingles of an item; one with fewer words is a single shingle."""
    length = min(SHINGLE, len(words))
    return length, {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)} if length else set()


def text_words(text: bytes) -> list[bytes]:
    return bytes(text).translate(_WORDS).split()


_WORDS = bytes(b if WORD_BYTE[b] else 32 for b in range(256))


def size_classes(shingles: list[tuple[int, set[bytes]]], threshold: float) -> list[SizeClass]:
    """Items by shingle length and by the power of two that their size is under.

    The sketch of an item is its k smallest shingle hashes, as in bottom-k MinHash. An item that shares
    ``threshold`` of its n shingles lacks at most n - ceil(threshold n), so with one more in the sketch a
    shared one is always among them; k is that number for the largest item of the class.
    """
    grouped = defaultdict(list)
    for number, (length, found) in enumerate(shingles):
        if found:
            grouped[length, len(found).bit_length()].append((number, found))
    classes = []
    for (length, _), members in sorted(grouped.items()):
        largest = max(len(found) for _, found in members)
        k = largest - math.ceil(threshold * largest - 1e-9) + 1
        hashes, items = [], []
        for number, found in members:
            joined = b" ".join(sorted(found))
            flat, offsets = np.frombuffer(joined, np.uint8), np.array([0, len(joined)])
            words = hashed_words(flat, offsets, WORD_BYTE)[0]
            sketch = np.sort(hashed_shingles(words, length)[::length])[:k]
            hashes.append(sketch)
            items.append(np.full(len(sketch), number))
        order = np.argsort(np.concatenate(hashes))
        hashes, items = np.concatenate(hashes)[order], np.concatenate(items)[order]
        least = min(math.ceil(threshold * len(found) - 1e-9) for _, found in members)
        bits = max(16, len(hashes).bit_length() + 4)
        bitmap = np.zeros(1 << bits, bool)
        bitmap[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
        classes.append(SizeClass(length, least, hashes, items, bitmap))
    return classes


def contained_items(texts: pa.Array, classes: list[SizeClass], shingles: list[tuple[int, set[bytes]]], threshold: float) -> list[list[tuple[int, int]]]:
    """Of each text the items that it holds, as (item, shared shingles)."""
    texts = pc.utf8_lower(texts)
    flat, offsets = flat_bytes(texts)
    words, _, _, before = hashed_words(flat, offsets, WORD_BYTE)
    candidates: dict[int, set[int]] = defaultdict(set)
    hashes_of: dict[int, np.ndarray] = {}
    for group in classes:
        if group.length not in hashes_of:
            hashes_of[group.length] = hashed_shingles(words, group.length)
        hashes = hashes_of[group.length]
        shift = np.uint64(64 - (len(group.bitmap).bit_length() - 1))
        likely = np.flatnonzero(group.bitmap[(hashes >> shift).astype(np.int64)])
        first = np.searchsorted(group.hashes, hashes[likely], "left")
        last = np.searchsorted(group.hashes, hashes[likely], "right")
        hit = last > first
        document = np.searchsorted(before, likely[hit], "right") - 1
        fits = (likely[hit] + group.length <= before[document + 1]) & (before[document + 1] - before[document] - group.length + 1 >= group.least)
        for d, a, b in {*zip(document[fits].tolist(), first[hit][fits].tolist(), last[hit][fits].tolist(), strict=True)}:
            candidates[d].update(group.items[a:b].tolist())
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for d, numbers in candidates.items():
        listed = text_words(flat[offsets[d] : offsets[d + 1]].tobytes())
        held: dict[int, set[bytes]] = {}
        for number in sorted(numbers):
            length, wanted = shingles[number]
            if length not in held:
                held[length] = {b" ".join(listed[i : i + length]) for i in range(len(listed) - length + 1)}
            shared = len(wanted & held[length])
            if shared >= math.ceil(threshold * len(wanted) - 1e-9):
                found[d].append((number, shared))
    return found


def _items(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The distinct items, and the bytes of their texts."""
    items = benchmark.select("item_id", text_of().alias("text")).distinct()
    return items, items.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _text_key() -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text_of()))


def _joined_matches(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """Matches of each distinct text, by joins: text_key, item_id, n_shingles, n_shared.

    Nothing that grows with the benchmark is in a task: a filter of bounded size drops most shingles of the documents, the
    rest meet the sketches by hash, and the texts of candidate pairs are compared by exact shingles.
    """
    numbered = stored(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, lengths, hashes = [], [], []
            texts = pc.utf8_lower(batch.column(1)).to_pylist()
            for number, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                length, found = item_shingles(text_words(text.encode()))
                if found:
                    (group,) = size_classes([(length, found)], threshold)
                    hashes += group.hashes.view(np.int64).tolist()
                    numbers += [number] * len(group.hashes)
                    lengths += [length] * len(group.hashes)
            columns = [pa.array(numbers, pa.int64()), pa.array(lengths, pa.int32()), pa.array(hashes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "length", "hash"])

    sketches = stored(numbered.select("item", "text").mapInArrow(sketched, "item long, length int, hash long"))
    bits = min(FILTER_MOST, 1 << max(16, (FILTER_BITS * sketches.count()).bit_length()))
    place = F.pmod("hash", F.lit(bits))
    # At most FILTER_MOST bits come to the driver, 4 KB in a row.
    parts = sketches.groupBy(F.shiftright(place, 15).alias("part")).agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits"))
    held = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():
        held[row.part * 4096 : (row.part + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(held.tobytes())
    lengths = [row.length for row in sketches.select("length").distinct().collect()]

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            start = 0
            for piece in pieces(batch.column(1)):
                flat, offsets = flat_bytes(pc.utf8_lower(piece))
                words, _, _, before = hashed_words(flat, offsets, WORD_BYTE)
                for length in lengths:
                    hashes = hashed_shingles(words, length)
                    at = hashes.view(np.int64) & (bits - 1)
                    hit = np.flatnonzero(held[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                    document = np.searchsorted(before, hit, "right") - 1
                    inside = hit + length <= before[document + 1]
                    pairs = np.unique(np.stack([document[inside], hashes[hit[inside]].view(np.int64)], axis=1), axis=0)
                    keys = batch.column(0).slice(start, len(piece)).take(pa.array(pairs[:, 0]))
                    yield pa.RecordBatch.from_arrays([keys, pa.array([length] * len(pairs), pa.int32()), pa.array(pairs[:, 1])], ["text_key", "length", "hash"])
                start += len(piece)

    texts = docs.select(_text_key().alias("text_key"), text_of().alias("text"))
    met = texts.mapInArrow(likely, "text_key binary, length int, hash long")
    candidates = stored(met.join(sketches, ["length", "hash"]).select("text_key", "item").distinct())
    wanted = texts.join(small(candidates.select("text_key").distinct()), "text_key", "left_semi").dropDuplicates(["text_key"])
    pairs = candidates.join(wanted, "text_key").join(numbered.withColumnRenamed("text", "item_text"), "item")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for text, item in zip(*(pc.utf8_lower(batch.column(i)).to_pylist() for i in (2, 3)), strict=True):
                length, wanted = item_shingles(text_words(item.encode()))
                listed = text_words(text.encode())
                sizes.append((len(wanted), len(wanted & {b" ".join(listed[i : i + length]) for i in range(len(listed) - length + 1)})))
            kept = [i for i, (n, both) in enumerate(sizes) if both >= math.ceil(threshold * n - 1e-9)]
            counts = [pa.array([sizes[i][k] for i in kept], pa.int32()) for k in (0, 1)]
            rest = [batch.column(i).take(pa.array(kept, pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*rest, *counts], ["text_key", "item_id", "n_shingles", "n_shared"])

    kind = items.schema["item_id"].dataType.simpleString()
    return pairs.select("text_key", "item_id", "text", "item_text").mapInArrow(
        compared, f"text_key binary, item_id {kind}, n_shingles int, n_shared int"
    )


def _search(items: list[tuple], threshold: float):
    """Column function from text to the matches with ``items`` (item_id, text)."""
    lowered = pc.utf8_lower(pa.array([text for _, text in items], pa.string()))
    shingles = [item_shingles(text_words(text.as_py().encode())) for text in lowered]
    classes = size_classes(shingles, threshold)

    @F.arrow_udf("array<struct<item: int, n_shingles: int, n_shared: int>>")
    def search(texts: pa.Array) -> pa.Array:
        lists = [pairs for piece in pieces(texts) for pairs in contained_items(piece, classes, shingles, threshold)]
        flat = [(item, len(shingles[item][1]), shared) for pairs in lists for item, shared in pairs]
        offsets = np.concatenate(([0], np.cumsum([len(pairs) for pairs in lists]))).astype(np.int32)
        columns = [pa.array([row[i] for row in flat], pa.int32()) for i in range(3)]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["item", "n_shingles", "n_shared"]))

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every pair of a document and a benchmark item of which the document has ``threshold`` of the word shingles.

    Columns: doc_id, item_id, n_shingles (distinct ones of the item), n_shared, containment. Words are runs of
    digits, letters and characters beyond ASCII, in lower case; shingles have five of them. An item of fewer
    words must stand in the document as a whole; one without words, such as a null text, matches nothing.
    Equal rows of ``benchmark`` count once, rows of ``docs`` that repeat match on their own.
    """
    items, size = _items(benchmark)
    if size > BLOCK_BYTES:
        matches = _joined_matches(docs, items, threshold)
        found = docs.select("doc_id", _text_key().alias("text_key")).join(small(stored(matches)), "text_key").drop("text_key")
    else:
        listed = [tuple(row) for row in items.collect()]
        item_type = items.schema["item_id"].dataType.simpleString()
        ids = docs.sparkSession.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(listed)], f"item int, item_id {item_type}")
        pairs = docs.select("doc_id", F.explode(_search(listed, threshold)(text_of())).alias("pair")).select("doc_id", "pair.*")
        # As many rows as items of BLOCK_BYTES.
        found = pairs.join(F.broadcast(ids), "item").select("doc_id", "item_id", "n_shingles", "n_shared")
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no benchmark item, with all columns of ``docs``; null and empty texts hold none, and of rows
    that repeat all stay or all go. An empty benchmark drops nothing."""
    items, size = _items(benchmark)
    if size <= BLOCK_BYTES:
        return docs.where(F.size(_search([tuple(row) for row in items.collect()], threshold)(text_of())) == 0)
    held = stored(_joined_matches(docs, items, threshold).select("text_key").distinct())
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), _text_key().alias("text_key"))
    return rows.join(small(held), "text_key", "left_anti").select("row.*")
