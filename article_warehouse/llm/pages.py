"""Main text of web pages, by differences between neighbouring pages of a host and by markup."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from article_warehouse.llm.common import pieces, small, stored
from article_warehouse.llm.markup import Line, text_lines

# Pages that a task compares together.
BLOCK = 256
# A page with this share of another's characters is a copy of it, and says nothing about the template.
COPY = 0.8
# Lines that are counted together in all pages of a block.
COLUMNS = 1024
# Comparisons of two lines that one table of the alignment may hold.
TABLE = 1 << 20


def main_text(pages: DataFrame) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars.

    Pages are put in the order of host and URL path. Each is aligned, by the longest common subsequence of lines, with the
    nearest page of its host (longest common beginning of the path) that is no copy of it, and lines that both share are
    deleted; a line is a block of text with the elements around it. All pages are aligned, with all their lines. Markup then
    checks what is left: lines in menus, headers, footers, sidebars, adverts, notices, forms and comments go in any case, and
    so do lines outside of the article where the page names one (``article``, else ``main``); prose within a named article is
    put back, as articles quote each other.

    A null or empty page has the empty text. Repeated rows are rows of their own. A page without host is compared with none.
    """
    found = stored(_signed(pages).distinct())
    deleted = stored(_deleted(found))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), _key().alias("key"))
    if deleted.isEmpty():
        rows = rows.withColumn("deleted", F.lit(None).cast("array<int>"))
    else:
        rows = rows.join(small(deleted), "key", "left")
    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return rows.select("page_id", "url", "html", "deleted").mapInArrow(_texts, schema)


def kept_lines(lines: list[Line]) -> list[bool]:
    """Whether each line may belong to the article, by markup alone."""
    named = [line.article for line in lines]
    if not any(named):
        named = [line.main and not line.chrome for line in lines]
    if any(named):
        return named
    return [not line.chrome and (line.prose or not line.links) for line in lines]


def _key() -> Column:
    """128 bits of a page's id, URL and content."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("\x01")) for name in ("page_id", "url", "html")]
    return F.unhex(F.md5(F.concat_ws("\x00", *parts)))


def _signed(pages: DataFrame) -> DataFrame:
    """Each page's lines as hashes: key, host, path, lines, sizes."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^#]*)", 1)
    rows = pages.select(_key().alias("key"), host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for piece in pieces(batch.column(3)):
                columns: list[list[bytes]] = [[], []]
                for page in piece.to_pylist():
                    lines = text_lines(page or "")
                    hashes = [xxhash.xxh3_64_intdigest(f"{line.path}\n{line.text}") for line in lines]
                    sizes = [0 if line.chrome else len(line.text) for line in lines]
                    for column, values, kind in zip(columns, (hashes, sizes), (np.uint64, np.int64), strict=True):
                        column.append(np.array(values, kind).tobytes())
                rest = [batch.column(i).slice(start, len(piece)) for i in range(3)]
                start += len(piece)
                yield pa.RecordBatch.from_arrays([*rest, *[pa.array(c, pa.binary()) for c in columns]], _SIGNED)

    return rows.mapInArrow(signed, "key binary, host string, path string, lines binary, sizes binary")


_SIGNED = ["key", "host", "path", "lines", "sizes"]


def _deleted(found: DataFrame) -> DataFrame:
    """Places of the lines that each page shares with its nearest neighbour: key, deleted.

    Pages are numbered in the order of host and path over all tasks and cut into blocks of ``BLOCK`` numbers. A block gets
    a page more on either side where its host goes on: the one next to the run of copies that reaches over the border, or
    the page at the border itself. So neither a large host nor the partitions nor a large group of copies matter.
    """
    placed = _placed(found)
    beside = F.array_distinct(F.array("block", F.floor((F.col("number") + 1) / BLOCK)))
    pages = placed.select("host", "lines", "sizes", "number", F.col("block").alias("home"), F.explode(beside).alias("block"))
    pages = pages.withColumn("own", F.col("block") == F.col("home")).drop("home")
    in_order = pages.repartition("block").sortWithinPartitions("block", "number")
    runs = in_order.mapInArrow(_runs, "host string, block long, start long, first long, last long")
    # At most two rows for each block.
    host = Window.partitionBy("host").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.last("last", ignorenulls=True).over(host.orderBy("block"))
    later = F.last("first", ignorenulls=True).over(host.orderBy(F.desc("block")))
    ends = runs.select(F.col("block").alias("to"), (F.coalesce("start", earlier) - 1).alias("before"), later.alias("after"))
    others = stored(ends.select("to", F.explode(F.array("before", "after")).alias("number")).where("number is not null"))
    added = placed.join(small(others), "number").select(*_SIGNED, "number", F.col("to").alias("block"), F.lit(False).alias("home"))
    dealt = placed.select(*_SIGNED, "number", "block", F.lit(True).alias("home")).unionAll(added)
    grouped = dealt.repartition("block").sortWithinPartitions("block", "number")
    return grouped.mapInArrow(_compared, "key binary, deleted array<int>")


def _placed(found: DataFrame) -> DataFrame:
    """Pages with a host, their numbers in the order of host and path, and the block that each is in."""
    order = ["host", "path", "key"]
    in_order = found.where("host <> ''").repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of the number are the partition, the lower ones the place in it.
    numbered = stored(in_order.withColumn("id", F.monotonically_increasing_id()))
    partition = F.shiftright("id", 33).alias("part")
    # One row for each partition.
    sizes = sorted(map(tuple, numbered.groupBy(partition).count().collect()))
    ends = np.cumsum([count for _, count in sizes]).tolist()
    firsts = [(part, end - count) for (part, count), end in zip(sizes, ends, strict=True)]
    offsets = found.sparkSession.createDataFrame(firsts, "part long, before long")
    placed = numbered.withColumn("part", partition).join(F.broadcast(offsets), "part")
    number = F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1)
    return placed.select(*_SIGNED, number.alias("number")).withColumn("block", F.floor(F.col("number") / BLOCK))


class _Page(NamedTuple):
    """A page's lines and its place in its host."""

    key: bytes
    host: str
    path: str
    lines: np.ndarray
    sizes: np.ndarray
    number: int

    @classmethod
    def of(cls, row: dict) -> _Page:
        lines, sizes = np.frombuffer(row["lines"], np.uint64), np.frombuffer(row["sizes"], np.int64)
        return cls(row.get("key", b""), row["host"], row.get("path", ""), lines, sizes, row["number"])

    def near(self, other: _Page) -> tuple[int, int]:
        """How many characters both paths begin with, then how few pages are between."""
        return len(commonprefix([self.path, other.path])), -abs(self.number - other.number)


def copies(pages: list[_Page]) -> np.ndarray:
    """Whether one of each two pages has most of its text in common with the other."""
    count = len(pages)
    lines, line = np.unique(np.concatenate([page.lines for page in pages]), return_inverse=True)
    sizes = np.concatenate([page.sizes for page in pages])
    page = np.repeat(np.arange(count), [len(page.lines) for page in pages])
    order = np.argsort(line, kind="stable")
    line, page, sizes = line[order], page[order], sizes[order]
    total = np.maximum(1, np.bincount(page, sizes, count))
    common = np.zeros((count, count))
    for start in range(0, len(lines), COLUMNS):
        part = slice(*np.searchsorted(line, (start, start + COLUMNS)))
        held, length = np.zeros((2, count, COLUMNS))
        held[page[part], line[part] - start] = 1
        np.add.at(length, (page[part], line[part] - start), sizes[part])
        shared = held.sum(axis=0) > 1
        common += length[:, shared] @ held[:, shared].T
    share = common / total[:, None]
    return np.maximum(share, share.T) >= COPY


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one block after the other."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, block in groupby(rows, key=lambda row: row["block"]):
        yield list(block)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where runs of copies begin in the first and the last host of a block.

    A run is pages of a host one after the other, each a copy of the one before. ``start`` is the number of the block's
    first page if a run begins there within its host, ``first`` and ``last`` those of the first and last run that do in
    this block.
    """

    def begins(pages: list[_Page], places: range) -> int | None:
        return next((pages[i].number for i in places if not copies(pages[i - 1 : i + 1])[0, 1]), None)

    for rows in _blocks(batches):
        found = []
        own = next((i for i, row in enumerate(rows) if row["own"]), len(rows))
        for host in dict.fromkeys(rows[i]["host"] for i in (own, -1) if own < len(rows)):
            pages = [_Page.of(row) for row in rows if row["host"] == host]
            places = range(1, len(pages))
            start = begins(pages, places[:1]) if own and rows[0]["host"] == host else None
            found.append((host, rows[-1]["block"], start, begins(pages, places), begins(pages, places[::-1])))
        columns = [pa.array(column, kind) for column, kind in zip(zip(*found), (pa.string(), *[pa.int64()] * 4), strict=False)]
        if columns:
            yield pa.RecordBatch.from_arrays(columns, ["host", "block", "start", "first", "last"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that each page of a block shares with its nearest page."""
    for rows in _blocks(batches):
        keys, places = [], []
        pages = [_Page.of(row) for row in rows]
        same = copies(pages)
        for _, host in groupby(range(len(pages)), key=lambda i: pages[i].host):
            members = list(host)
            for i in members:
                if rows[i]["home"]:
                    # Paths of pages further away have less in common, so one on either side will do.
                    before = next((pages[j] for j in range(i - 1, members[0] - 1, -1) if not same[i, j]), None)
                    after = next((pages[j] for j in range(i + 1, members[-1] + 1) if not same[i, j]), None)
                    nearest = max((other for other in (before, after) if other), key=pages[i].near, default=None)
                    gone = shared_lines(pages[i], nearest) if nearest else []
                    if len(gone):
                        keys.append(pages[i].key)
                        places.append(gone)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(places, pa.list_(pa.int32()))], ["key", "deleted"])


def shared_lines(page: _Page, nearest: _Page) -> list[int]:
    """Places of the lines of a page that are aligned with equal ones of another."""
    # Lines that the other page lacks can't be aligned.
    mine, theirs = np.flatnonzero(np.isin(page.lines, nearest.lines)), np.flatnonzero(np.isin(nearest.lines, page.lines))
    return mine[common_subsequence(page.lines[mine].tolist(), nearest.lines[theirs].tolist())].tolist()


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both.

    Lengths for all beginnings of ``b`` are kept as the zero bits of one number, which each element of ``a`` updates with
    a few operations on whole words. Long inputs are split in the middle of ``a``, where the best place in ``b`` is known
    from both directions, so memory grows with the longer list only.
    """
    if not a or not b:
        return []
    if len(a) * len(b) <= TABLE:
        lengths = np.stack([np.zeros(len(b) + 1, np.int32), *_lengths(a, b, each=True)])
        found, i, j = [], len(a), len(b)
        while i and j:
            if lengths[i, j] == lengths[i - 1, j]:
                i -= 1
            elif lengths[i, j] == lengths[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append(i)
        return found[::-1]
    if len(a) == 1:
        return [0] if a[0] in b else []
    half = len(a) // 2
    before, after = _lengths(a[:half], b)[0], _lengths(a[half:][::-1], b[::-1])[0][::-1]
    cut = int((before + after).argmax())
    return common_subsequence(a[:half], b[:cut]) + [half + i for i in common_subsequence(a[half:], b[cut:])]


def _lengths(a: list[int], b: list[int], each: bool = False) -> list[np.ndarray]:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``; with ``each`` for all beginnings of ``a``."""
    places: dict[int, list[int]] = {}
    for i, value in enumerate(b):
        places.setdefault(value, []).append(i)
    # Only values with many places have their bits at hand; bits of all would take the square of the length.
    bits = {value: sum(1 << i for i in at) for value, at in places.items() if len(at) > 64}
    full = (1 << len(b)) - 1
    row, rows = full, []
    for value in a:
        met = row & (bits[value] if value in bits else sum(1 << i for i in places.get(value, ())))
        row = ((row + met) | (row - met)) & full
        if each:
            rows.append(row)
    size = (len(b) + 7) // 8
    found = []
    for row in rows if each else [row]:
        zeros = 1 - np.unpackbits(np.frombuffer(row.to_bytes(size, "little"), np.uint8), count=len(b), bitorder="little").astype(np.int32)
        found.append(np.concatenate([[0], np.cumsum(zeros)]).astype(np.int32))
    return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start = 0
        for piece in pieces(batch.column(2)):
            part = batch.slice(start, len(piece))
            start += len(piece)
            texts = [page_text(page, gone) for page, gone in zip(piece.to_pylist(), part.column(3).to_pylist(), strict=True)]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])


def page_text(page: str | None, deleted: list[int] | None = None) -> str:
    """Text of the lines that are left without those at the places ``deleted``, as checked by markup."""
    lines, gone = text_lines(page or ""), set(deleted or ())
    left = [i not in gone or (line.article and line.prose) for i, line in enumerate(lines)]
    return "\n\n".join(line.text for line, kept, stays in zip(lines, kept_lines(lines), left, strict=True) if kept and stays)
