"""Partitioned reads of the ``articles`` table of a PostgreSQL database.

Time bounds are sent as literals with an explicit offset. Left to the filter push-down of the
JDBC reader they would be printed in the session time zone and read in the database's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from article_warehouse.functions import utc_naive
from article_warehouse.operators.keys import digest_query
from article_warehouse.operators.scans import source_ids
from article_warehouse.schemas import ARTICLES, ARTICLES_SCHEMA


def sql_instant(value: datetime | str) -> str:
    return f"TIMESTAMPTZ '{utc_naive(value).isoformat(sep=' ')}+00'"


def sql_range(column: str, start: datetime | str, end: datetime | str) -> str:
    return f"{column} >= {sql_instant(start)} AND {column} < {sql_instant(end)}"


def ranges(start: datetime | str, end: datetime | str, step: timedelta) -> list[tuple[datetime, datetime]]:
    """``[start, end)`` cut into adjoining ranges of length ``step``, the last one shorter."""
    start, end = utc_naive(start), utc_naive(end)
    count = max(0, -((start - end) // step))
    return [(start + step * i, min(start + step * (i + 1), end)) for i in range(count)]


def range_predicates(
    column: str,
    cuts: Sequence[tuple[datetime, datetime]],
    counted: Mapping[int, tuple[int, int, int]],
    max_rows: int,
    bounds_of: Mapping[int, Sequence[int]] = {},
) -> list[str]:
    """One read per range; a range above ``max_rows`` is divided further by bounds of the id.

    ``counted`` has rows, lowest and highest id of a range, ``bounds_of`` the ids that a range is divided at if it has
    gaps; others are divided into equal widths. Bounds of ids split rows that share one time too,
    and an index on the id serves them. The first and the last read of a range are open, and a range without a count
    is still read, as rows may have arrived since the counting.
    """
    predicates = []
    for index, (start, end) in enumerate(cuts):
        within = sql_range(column, start, end)
        rows, lowest, highest = counted.get(index, (0, 0, 0))
        parts = max(1, min(-(-rows // max_rows), highest - lowest + 1))
        bounds = [lowest + (highest - lowest + 1) * part // parts for part in range(1, parts)]
        predicates += [" AND ".join([within, *between]) for between in id_predicates(bounds_of.get(index, bounds))]
    return predicates or ["1 = 0"]


def id_predicates(bounds: Sequence[int]) -> list[list[str]]:
    """Conditions of reads that are divided at ids ``bounds``; the first and the last read are open."""
    lower = [[], *[[f"id >= {bound}"] for bound in bounds]]
    upper = [*[[f"id < {bound}"] for bound in bounds], []]
    return [low + high for low, high in zip(lower, upper, strict=True)]


def has_gaps(rows: int, lowest: int, highest: int) -> bool:
    """Whether reads of equal width could hold more than twice their share of the ids."""
    return highest - lowest + 1 > 2 * rows


def span_predicates(spans: Sequence[tuple[int, int]], max_rows: int) -> list[str]:
    """Reads of about ``max_rows`` ids at most that cover spans ``[first, end)``; neighbouring short spans share one."""
    predicates, held, rows = [], [], 0
    for first, end in spans:
        while first < end:
            stop = min(end, first + max_rows - rows)
            held.append(f"(id >= {first} AND id < {stop})")
            rows, first = rows + stop - first, stop
            if rows >= max_rows:
                predicates.append(" OR ".join(held))
                held, rows = [], 0
    if held:
        predicates.append(" OR ".join(held))
    return predicates or ["1 = 0"]


def _range_index(column: str, start: datetime, step: timedelta) -> str:
    return f"floor(extract(epoch FROM {column} - {sql_instant(start)}) / {step.total_seconds()})"


class JdbcSource:
    """Articles in a database, read in parallel by ranges that the database's indexes serve.

    ``max_rows`` bounds one read, ``fetch_size`` one round trip, and ``change_reads`` the number
    of ranges that a window of changes is cut into.
    """

    # Parallel reads are not one snapshot: a row that changes in between can be read twice.
    on_duplicate = "latest"

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        table: str = ARTICLES,
        properties: Mapping[str, str] | None = None,
        fetch_size: int = 5000,
        max_rows: int = 1_000_000,
        change_reads: int = 16,
    ):
        self.spark, self.url, self.table = spark, url, table
        self.max_rows, self.change_reads = max_rows, change_reads
        self.properties = {
            "driver": "org.postgresql.Driver",
            **(properties or {}),
            "fetchsize": str(fetch_size),
        }

    def _read(self, predicates: list[str]) -> DataFrame:
        frame = self.spark.read.jdbc(self.url, self.table, predicates=predicates, properties=self.properties)
        return frame.select(*ARTICLES_SCHEMA.names)

    def _query(self, query: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, f"({query}) AS answer", properties=self.properties)

    def rows(self) -> DataFrame:
        bounds = self.id_bounds()
        if bounds:
            return self._read([" AND ".join(between) for between in id_predicates(bounds)])
        options = self.id_read_options()
        frame = self.spark.read.jdbc(self.url, self.table, properties=self.properties, **options)
        return frame.select(*ARTICLES_SCHEMA.names)

    def changed(self, start: datetime, end: datetime) -> DataFrame:
        span = utc_naive(end) - utc_naive(start)
        step = max(span / self.change_reads, timedelta(microseconds=1))
        return self._in_ranges("updated_at", start, end, step)

    def created(self, start: datetime, end: datetime, days: int) -> DataFrame:
        return self._in_ranges("created_at", start, end, timedelta(days=days))

    def window_rows(self, start: datetime, end: datetime, days: int) -> dict[int, int]:
        """Number of rows created in each window of ``days`` days that has any, which the database counts."""
        counts = self._query(self.count_query("created_at", start, end, timedelta(days=days))).collect()
        return {int(row["range_index"]): int(row["row_count"]) for row in counts}

    def ids(self) -> DataFrame:
        return source_ids(self.rows())

    def id_digests(self) -> DataFrame:
        """Digests per range of the ids of rows that are not deleted, which the database computes."""
        return self._query(digest_query(self.table))

    def ids_within(self, spans: list[tuple[int, int]]) -> DataFrame:
        """Ids of the given spans only, which an index on the id serves."""
        return source_ids(self._read(span_predicates(spans, self.max_rows)))

    def _in_ranges(self, column: str, start: datetime, end: datetime, step: timedelta) -> DataFrame:
        # The database counts; one row per range comes back.
        counts = {
            int(row["range_index"]): (int(row["row_count"]), int(row["lowest"]), int(row["highest"]))
            for row in self._query(self.count_query(column, start, end, step)).collect()
        }
        bounds: dict[int, list[int]] = {}
        if any(rows > self.max_rows and has_gaps(rows, *ends) for rows, *ends in counts.values()):
            # A row for each read, which the database finds in the order of ids.
            for row in self._query(self.cut_query(column, start, end, step)).collect():
                bounds.setdefault(int(row["range_index"]), []).append(int(row["id"]))
        bounds = {index: sorted(ids) for index, ids in bounds.items() if has_gaps(*counts.get(index, (0, 0, 0)))}
        return self._read(range_predicates(column, ranges(start, end, step), counts, self.max_rows, bounds))

    def count_query(self, column: str, start: datetime, end: datetime, step: timedelta) -> str:
        return (
            f"SELECT {_range_index(column, start, step)} AS range_index, count(*) AS row_count, "
            f"min(id) AS lowest, max(id) AS highest FROM {self.table} WHERE {sql_range(column, start, end)} GROUP BY 1"
        )

    def cut_query(self, column: str, start: datetime, end: datetime, step: timedelta) -> str:
        """Of each range every ``max_rows``-th id, so that reads between them are equally deep."""
        number = _range_index(column, start, step)
        placed = (
            f"SELECT {number} AS range_index, id, row_number() OVER (PARTITION BY {number} ORDER BY id) - 1 AS place "
            f"FROM {self.table} WHERE {sql_range(column, start, end)}"
        )
        return f"SELECT range_index, id FROM ({placed}) AS placed WHERE place > 0 AND mod(place, {self.max_rows}) = 0"

    def id_bounds(self) -> list[int]:
        """Every ``max_rows``-th id of a table whose ids have gaps; none for others, which equal widths divide well."""
        counted = self._query(f"SELECT count(*) AS row_count, min(id) AS lowest, max(id) AS highest FROM {self.table}").first()
        rows = int(counted["row_count"])
        if rows <= self.max_rows or not has_gaps(rows, int(counted["lowest"]), int(counted["highest"])):
            return []
        placed = f"SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM {self.table}"
        cuts = self._query(f"SELECT id FROM ({placed}) AS placed WHERE place > 0 AND mod(place, {self.max_rows}) = 0")
        return sorted(int(row["id"]) for row in cuts.collect())

    def id_read_options(self) -> dict:
        """Partitioning by id ranges, from the bounds that the key index gives."""
        bounds = self._query(f"SELECT min(id) AS lowest, max(id) AS highest FROM {self.table}").first()
        if bounds["lowest"] is None:
            return {}
        lowest, highest = int(bounds["lowest"]), int(bounds["highest"])
        reads = max(1, -(-(highest - lowest + 1) // self.max_rows))
        return {"column": "id", "lowerBound": lowest, "upperBound": highest + 1, "numPartitions": reads}
