"""The warehouse tables: external Parquet tables of the session's catalog.

Data is written to a new folder per run, and the catalog is then pointed at it, partition by
partition. Files that the catalog points at are never changed, so a lost executor or a failed
job leaves every table as it was. There is one writer at a time.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from article_warehouse import schemas as S
from article_warehouse.files import delete_folder, partition_locations, stored_bytes, subfolders
from article_warehouse.functions import instant, to_utc, utc_naive, utc_now
from article_warehouse.operators.calendar import (
    DATE_KEYS,
    FIRST_DATE,
    LAST_DATE,
    PLAUSIBLE_YEARS,
    covering_calendar,
    date_dimension,
    key_outliers,
)
from article_warehouse.operators.keys import differing_ranges, id_spans, key_bitmaps, key_digests, key_range, located
from article_warehouse.operators.merge import (
    BROADCAST_KEYS,
    duplicate_keys,
    keep_latest,
    key_profile,
    mark_deleted,
    merge_upsert,
    missing_from_source,
    require_unique,
    row_fingerprint,
    sized_keys,
)
from article_warehouse.operators.rollup import article_rollup, authors_of_rollup

PERIOD, SLICE = "created_period", "key_slice"
PARTITION = [PERIOD, SLICE]
PARTITION_SCHEMA = T.StructType([T.StructField(name, T.IntegerType()) for name in PARTITION])
CLUSTERING = ["author_id", S.ARTICLE_KEY]
# A column of the stored fact that readers don't see.
FINGERPRINT = "row_fingerprint"
HIDDEN = [FINGERPRINT, *PARTITION]

_YEARS = "calendar.years"
_PENDING = "pending_publication"
# Set with each publication, cleared once the author dimension is computed from what was published.
_AUTHORS_BEHIND = "authors_behind"

Partition = tuple[int, int]


@dataclass(frozen=True)
class Companion:
    """A table with a partition for each one of the fact, made from its rows and published with it.

    The files lie in a folder of their own beside the partitions they were made of.
    """

    table: str
    description: str
    schema: T.StructType
    columns: tuple[str, ...]
    make: Callable[..., DataFrame]
    order: tuple[str, ...]

    def folder(self, location: str) -> str:
        # Readers of the fact's files pass over names that begin so.
        return f"{location}/_{self.table}"

    def beside(self, partition_folder: str) -> str:
        location, period, part = partition_folder.rsplit("/", 2)
        return f"{self.folder(location)}/{period}/{part}"


COMPANIONS = (
    Companion(
        S.KEYS, "Article keys of each partition of the fact", S.KEYS_SCHEMA,
        (S.ARTICLE_KEY, "is_deleted"), key_bitmaps, ("key_range",),
    ),
    Companion(
        S.ROLLUP, "Articles by author and publication day in each partition of the fact", S.ROLLUP_SCHEMA,
        ("author_id", "published_date_key", "is_deleted", "word_count", "created_at", "updated_at"),
        article_rollup, ("author_id", "published_date_key"),
    ),
)


class DeleteGuardError(RuntimeError):
    """A delete reconciliation would mark more rows than allowed."""


PARTITION_BYTES = 4 << 30
# Size that the tasks which write the fact aim at, as shuffled. They sort whole rows, which are longer in memory; with more
# than a task has of it, rows are spilled and read again.
FILE_BYTES = 128 << 20
# Lookups by key skip row groups. The filter of a row group is the smallest of eight lengths that its keys fit, 128 KB at
# most, which is about one false hit in a hundred for 100,000 keys.
BLOOM = {
    f"parquet.bloom.filter.enabled#{S.ARTICLE_KEY}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number": "8",
    "parquet.bloom.filter.max.bytes": str(1 << 17),
}
# Catalog statements of a publication, or folders being measured, that are under way at a time.
CATALOG_THREADS = 8
# Ranges of ids that are read from the source one by one; beyond that all ids are read.
RANGE_READS = 10_000


def _slices_for(size: float, per_partition: int) -> int:
    return max(1, math.ceil(size / per_partition))


@dataclass(frozen=True)
class Layout:
    """Physical partitions of the fact: a UTC period of ``created_at`` and a slice of the keys.

    A merge rewrites the partitions it touches, so they bound its cost. ``hot`` gives periods that
    need another number of slices than usual a number of their own. A period that outgrows
    ``partition_bytes`` a slice gets more of them with the merge that makes it so large.
    """

    grain: str = "month"
    slices: int = 1
    hot: tuple[tuple[int, int], ...] = ()
    partition_bytes: int = PARTITION_BYTES

    def __post_init__(self) -> None:
        if self.grain not in ("day", "month", "year"):
            raise ValueError(f"unknown grain: {self.grain}")
        if not all(slices >= 1 for slices in (self.slices, *dict(self.hot).values())):
            raise ValueError("a period has one slice at least")

    @classmethod
    def for_bytes(cls, total: int, years: int = 10, per_partition: int = PARTITION_BYTES) -> Layout:
        """The coarsest layout that keeps an average partition within ``per_partition`` bytes."""
        for grain, periods in (("year", years), ("month", 12 * years)):
            if total <= periods * per_partition:
                return cls(grain, partition_bytes=per_partition)
        return cls("day", _slices_for(total / (365 * years), per_partition), partition_bytes=per_partition)

    @classmethod
    def for_articles(cls, articles: DataFrame, total: int, per_partition: int = PARTITION_BYTES) -> Layout:
        """A layout for ``total`` bytes spread over periods as the creation times of ``articles`` are."""
        grain = cls.for_bytes(total, per_partition=per_partition).grain
        period = cls(grain).period(to_utc(articles, "created_at"))
        # One row per period.
        counts = dict(tuple(row) for row in articles.groupBy(period).count().collect())
        rows = sum(counts.values())
        needed = {p: _slices_for(total * count / rows, per_partition) for p, count in counts.items()}
        usual = sorted(needed.values())[len(needed) // 2] if needed else 1
        return cls(grain, usual, tuple(sorted((p, n) for p, n in needed.items() if n != usual)), per_partition)

    @classmethod
    def from_properties(cls, properties: Mapping[str, str]) -> Layout:
        prefix = "layout.slices."
        hot = sorted((int(k.removeprefix(prefix)), int(v)) for k, v in properties.items() if k.startswith(prefix))
        size = int(properties.get("layout.partition_bytes", PARTITION_BYTES))
        return cls(properties["layout.grain"], int(properties["layout.slices"]), tuple(hot), size)

    def properties(self) -> dict[str, str]:
        hot = {f"layout.slices.{period}": str(slices) for period, slices in self.hot}
        sizes = {"layout.slices": str(self.slices), "layout.partition_bytes": str(self.partition_bytes)}
        return {"layout.grain": self.grain, **sizes, **hot}

    def slices_of(self, period: int) -> int:
        return dict(self.hot).get(period, self.slices)

    def grown(self, sizes: Mapping[int, int]) -> Layout:
        """This layout with more slices for periods whose bytes outgrow theirs.

        They get room for twice their bytes, so that a growing period is sliced anew a few times only.
        """
        own = dict(self.hot)
        for period, size in sizes.items():
            slices = own.get(period, self.slices)
            if size > slices * self.partition_bytes:
                own[period] = _slices_for(2 * size, self.partition_bytes)
        return replace(self, hot=tuple(sorted(own.items())))

    def period(self, created: Column) -> Column:
        """The period as an integer such as 201612; 0 for a row without creation time."""
        number = F.year(created)
        if self.grain != "year":
            number = number * 100 + F.month(created)
        if self.grain == "day":
            number = number * 100 + F.dayofmonth(created)
        return F.coalesce(number, F.lit(0)).cast("int")

    def period_number(self, value: datetime) -> int:
        text = value.strftime("%Y%m%d")
        return int(text[: {"year": 4, "month": 6, "day": 8}[self.grain]])

    def slice(self, key: Column, period: Column) -> Column:
        slices = F.lit(self.slices)
        if self.hot:
            counts = F.create_map(*[F.lit(number) for entry in self.hot for number in entry])
            slices = F.coalesce(F.try_element_at(counts, period), slices)
        return F.pmod(F.xxhash64(key), slices).cast("int")

    def place(self, rows: DataFrame) -> DataFrame:
        placed = rows.withColumn(PERIOD, self.period(F.col("created_at")))
        if not self.hot:
            return placed.withColumn(SLICE, self.slice(F.col(S.ARTICLE_KEY), F.col(PERIOD)))
        # At most one row per period; a join finds them without a search through a list for each row.
        own = rows.sparkSession.createDataFrame(list(self.hot), f"{PERIOD} int, own_slices int")
        slices = F.coalesce("own_slices", F.lit(self.slices))
        numbered = placed.join(F.broadcast(own), PERIOD, "left")
        return numbered.withColumn(SLICE, F.pmod(F.xxhash64(S.ARTICLE_KEY), slices).cast("int")).select(
            *rows.columns, PERIOD, SLICE
        )


def _within(partitions: Iterable[Partition]) -> Column:
    """Rows of the given partitions; it refers to partition columns only, so other files are not read."""
    partitions = sorted(partitions)
    listed = ", ".join(f"{(period << 32) + part}L" for period, part in partitions)
    # The range of periods is the part that a catalog can evaluate itself.
    return F.expr(
        f"{PERIOD} BETWEEN {partitions[0][0]} AND {partitions[-1][0]} "
        f"AND {PERIOD} * {1 << 32}L + {SLICE} IN ({listed})"
    )


def _partition_rows(rows: DataFrame) -> dict[Partition, int]:
    """Number of ``rows`` in each partition; at most one entry per partition of the fact."""
    return {(row[PERIOD], row[SLICE]): row["count"] for row in rows.groupBy(*PARTITION).count().collect()}


def _distinct_partitions(rows: DataFrame) -> set[Partition]:
    return set(_partition_rows(rows))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class StagedBatch:
    """A batch as stored: the rows that a merge applies."""

    folder: str
    location: str = ""
    rows: DataFrame | None = None
    row_count: int = 0
    taken_over: bool = False
    # Partitions that held repeated keys, and where they stand without them.
    cleared: frozenset[Partition] = frozenset()
    cleared_location: str = ""
    # Set by the merge: rows that the fact has already, and partitions that were written or dropped.
    unchanged: int = 0
    published: set[Partition] = field(default_factory=set)

    def location_of(self, partition: Partition) -> str:
        return self.cleared_location if partition in self.cleared else self.location


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        database: str = "article_warehouse",
        layout: Layout = Layout(),
        file_bytes: int = FILE_BYTES,
        years: tuple[int, int] = PLAUSIBLE_YEARS,
    ):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.file_bytes = file_bytes
        self._wanted_years = years
        self._wanted_layout = layout

    # Tables

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        """A table without its physical partition columns."""
        return self.spark.table(self.name(table)).drop(*HIDDEN)

    def fact(self, created_from: datetime | None = None, created_until: datetime | None = None) -> DataFrame:
        """The fact, or its rows created in ``[created_from, created_until)`` from matching partitions only."""
        frame = self.spark.table(self.name(S.FACT))
        layout = self.layout
        if created_from is not None:
            frame = frame.where(F.col(PERIOD) >= layout.period_number(utc_naive(created_from)))
            frame = frame.where(F.col("created_at") >= instant(created_from))
        if created_until is not None:
            frame = frame.where(F.col(PERIOD) <= layout.period_number(utc_naive(created_until)))
            frame = frame.where(F.col("created_at") < instant(created_until))
        return frame.drop(*HIDDEN)

    def article(self, article_id: str) -> DataFrame:
        """One fact row, looked up in the partition that the key bitmaps name, where bloom filters skip row groups."""
        key = self.spark.createDataFrame([(article_id,)], f"{S.ARTICLE_KEY} string")
        # Without a publication under way one partition, or a few for keys that are no numbers.
        partitions = _distinct_partitions(self.locate(key, 1))
        frame = self.spark.table(self.name(S.FACT))
        rows = frame.where(_within(partitions) if partitions else F.lit(False))
        return rows.where(F.col(S.ARTICLE_KEY) == article_id).drop(*HIDDEN)

    def locate(self, keys: DataFrame, count: int) -> DataFrame:
        """The partitions that have each of ``count`` keys, by bitmaps: ``article_id`` and the partition.

        Exact for keys that are whole numbers. The fact itself is not read.
        """
        return located(self.spark.table(self.name(S.KEYS)), keys, count, *PARTITION)

    @property
    def layout(self) -> Layout:
        """The layout that the fact was created with, and the slices of periods that grew since."""
        return Layout.from_properties(self._properties(S.FACT))

    @property
    def years(self) -> tuple[int, int]:
        """First and last year of days that the calendar may have; articles of others are listed in a table of their own."""
        stored = self._properties(S.FACT).get(_YEARS)
        return tuple(int(year) for year in stored.split("-")) if stored else PLAUSIBLE_YEARS

    @property
    def companions(self) -> tuple[Companion, ...]:
        outliers = Companion(
            S.OUTLIERS, "Articles with a date of an implausible year in each partition of the fact", S.OUTLIERS_SCHEMA,
            (S.ARTICLE_KEY, *DATE_KEYS), partial(key_outliers, years=self.years), (S.ARTICLE_KEY,),
        )
        return (*COMPANIONS, outliers)

    def ensure_table(
        self,
        table: str,
        schema: T.StructType,
        description: str,
        partition_schema: T.StructType | None = None,
        properties: dict[str, str] | None = None,
    ) -> None:
        """Create a table if it is missing, and add columns that an existing one lacks."""
        if self.spark.catalog.tableExists(self.name(table)):
            self.add_missing_columns(table, schema)
            return
        partition_schema = partition_schema or T.StructType()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema, *partition_schema])
        partitioned = f"PARTITIONED BY ({', '.join(partition_schema.names)})" if partition_schema.names else ""
        stored = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in (properties or {}).items())
        stored = f"TBLPROPERTIES ({stored})" if stored else ""
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {partitioned} "
            f"COMMENT {_quoted(description)} LOCATION {_quoted(f'{self.root}/{table}/initial')} {stored}"
        )

    def add_missing_columns(self, table: str, schema: T.StructType) -> list[str]:
        """Append declared columns that the table lacks; none is dropped or retyped."""
        present = set(self.spark.table(self.name(table)).columns)
        missing = [field for field in schema if field.name not in present]
        if missing:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")
        return [field.name for field in missing]

    def bootstrap(self, first_date: str = FIRST_DATE, last_date: str = LAST_DATE) -> None:
        """Make sure that all tables exist, finish an interrupted publication and seed the calendar.

        The dates say what a new calendar covers; it grows with the rows that are loaded.
        """
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.database} "
            f"COMMENT 'Article star schema' LOCATION {_quoted(self.root)}"
        )
        self.ensure_table(
            S.FACT,
            T.StructType([*S.FACT_SCHEMA, T.StructField(FINGERPRINT, T.LongType())]),
            "Articles, one row per article_id",
            PARTITION_SCHEMA,
            {**self._wanted_layout.properties(), _YEARS: "-".join(map(str, self._wanted_years))},
        )
        self.ensure_table(S.DATES, S.DATES_SCHEMA, "Calendar days, one row per date_key")
        self.ensure_table(S.AUTHORS, S.AUTHORS_SCHEMA, "Authors seen in the articles, one row per author_id")
        self.ensure_table(S.CONTROL, S.CONTROL_SCHEMA, "State and high-water mark of each process")
        self.make_ready()
        if self.table(S.DATES).isEmpty():
            self.replace_table(S.DATES, date_dimension(self.spark, first_date, last_date).coalesce(1))

    # Writing

    def _new_folder(self, table: str) -> str:
        return f"{self.root}/{table}/{utc_now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"

    def replace_table(self, table: str, rows: DataFrame) -> None:
        """Replace the contents of an unpartitioned table."""
        location = self._new_folder(table)
        self._write(rows, location)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION {_quoted(location)}")

    def _cover_days(self, rows: DataFrame) -> None:
        """Extend the calendar to the date keys of ``rows``."""
        dates = self.table(S.DATES)
        held = dates.agg(F.min("date_actual").alias("first"), F.max("date_actual").alias("last")).first()
        if held["first"] is None:
            return
        wider = covering_calendar(rows, str(held["first"]), str(held["last"]), self.years)
        ends = wider.agg(F.min("date_actual").alias("first"), F.max("date_actual").alias("last")).first()
        if ends != held:
            self.replace_table(S.DATES, wider.coalesce(1))

    def refresh_authors(self, as_of: datetime) -> None:
        """Compute the author dimension from the rollup, whose parts were renewed with the partitions of the fact."""
        self.replace_table(S.AUTHORS, authors_of_rollup(self.table(S.ROLLUP), as_of))
        self._set_properties({_AUTHORS_BEHIND: ""})

    def catch_up_authors(self, as_of: datetime) -> None:
        """Refresh the author dimension if the fact changed since, also in a run that did not come so far."""
        if self._properties(S.FACT).get(_AUTHORS_BEHIND):
            self.refresh_authors(as_of)

    @contextmanager
    def staged(self, batch: DataFrame, on_duplicate: str = "error") -> Iterator[StagedBatch]:
        """``batch`` computed once, into files of the fact's layout, and with its keys checked.

        ``on_duplicate`` says what to do about repeated keys: ``error``, or ``latest`` to keep the
        row updated last. Files that a merge did not take over are removed at the end.
        """
        if on_duplicate not in ("error", "latest"):
            raise ValueError(f"unknown handling of repeated keys: {on_duplicate}")
        self.make_ready()
        staged = StagedBatch(self._new_folder(S.FACT))
        try:
            self._fill(staged, batch, on_duplicate)
            yield staged
        finally:
            if not staged.taken_over:
                delete_folder(self.spark, staged.folder)

    def _fill(self, staged: StagedBatch, batch: DataFrame, on_duplicate: str) -> None:
        staged.location = f"{staged.folder}/batch"
        self._write_fact(self.layout.place(batch), staged.location)
        columns = [*batch.columns, FINGERPRINT]
        staged.rows = self._fact_files(staged.location, columns)
        # Counted in the stored files: metrics of a running job count repeated tasks twice.
        profile = key_profile(staged.rows)
        if profile["without_key"]:
            raise ValueError(f"{profile['without_key']} rows have no {S.ARTICLE_KEY}")
        if profile["repeated_keys"]:
            if on_duplicate == "error":
                require_unique(staged.rows)
            # Only partitions that hold a repeated key are written again, and only such rows compared.
            repeated = duplicate_keys(staged.rows)
            keys = sized_keys(repeated.select(S.ARTICLE_KEY), profile["repeated_keys"])
            staged.cleared = frozenset(_distinct_partitions(staged.rows.join(keys, S.ARTICLE_KEY, "left_semi")))
            within = _within(staged.cleared)
            latest = keep_latest(staged.rows.where(within), repeated=(repeated, profile["repeated_keys"]))
            staged.cleared_location = f"{staged.folder}/latest"
            self._write_fact(latest, staged.cleared_location)
            cleared = self._fact_files(staged.cleared_location, columns)
            staged.rows = staged.rows.where(~within).unionByName(cleared)
        staged.row_count = profile["key_count"]

    def merge_fact(self, batch: DataFrame, on_duplicate: str = "error") -> int:
        """Upsert fact rows by ``article_id``; returns the number of rows in the batch."""
        with self.staged(batch, on_duplicate) as staged:
            self.merge_staged(staged)
            return staged.row_count

    def merge_staged(self, staged: StagedBatch, properties: Mapping[str, str] = {}) -> None:
        """Upsert a stored batch; table properties given are set by the statement that commits it.

        The key bitmaps say where its keys are, and only keys and fingerprints of these partitions are read. Rows that
        the fact has already, as a repeated window brings them, change nothing. Partitions that the fact does not have
        yet take the stored files as they are. The others that hold a key of a changed row, or will, are rewritten, and so
        are all of a period that outgrows its slices; its new number of slices is committed with the publication.
        """
        if not staged.row_count:
            self._set_properties(properties)
            return
        fact, existing, layout = self.spark.table(self.name(S.FACT)), self.partitions(), self.layout
        complete = set(fact.columns) == set(staged.rows.columns)
        replaced, rows = self._changes(staged, complete) if existing else ({}, staged.rows)
        if staged.unchanged == staged.row_count:
            self._set_properties(properties)
            return
        changed_rows = staged.row_count - staged.unchanged
        added = _partition_rows(rows)
        current, incoming = set(replaced), set(added)
        wider = layout.grown(self._period_bytes(staged, added, replaced))
        resliced = {period for period, slices in wider.hot if slices != layout.slices_of(period)}
        # Columns that only the table has keep their value, which the stored files do not hold.
        fresh = incoming - existing if complete or not existing else set()
        fresh = {partition for partition in fresh if partition[0] not in resliced}
        outgrown = {partition for partition in existing if partition[0] in resliced}
        rewritten = (current | incoming | outgrown) - fresh
        published = {partition: _folder(staged.location_of(partition), partition) for partition in fresh}
        dropped: set[Partition] = set()
        with ThreadPoolExecutor(1) as threads:
            # Meanwhile, since a calendar that is wider than the fact does no harm.
            covered = threads.submit(self._cover_days, rows)
            if rewritten:
                location = self._new_folder(S.FACT)
                merged = merge_upsert(fact.where(_within(rewritten)), rows, batch_rows=changed_rows)
                merged = merged.where(_within(rewritten))
                self._write_fact(wider.place(merged.drop(*PARTITION)) if resliced else merged, location)
                written = _distinct_partitions(self._fact_files(location, fact.columns))
                self._write_companions(location, written)
                published |= {partition: _folder(location, partition) for partition in written}
                dropped = (rewritten & existing) - written
            for location, taken in ((staged.location, fresh - staged.cleared), (staged.cleared_location, fresh & staged.cleared)):
                self._write_companions(location, taken)
            covered.result()
        staged.taken_over, staged.published = bool(fresh), set(published) | dropped
        self._publish(published, dropped, {**properties, **(wider.properties() if resliced else {})})

    def _changes(self, staged: StagedBatch, complete: bool) -> tuple[dict[Partition, int], DataFrame]:
        """Rows that a batch replaces, counted by partition, and the rows of the batch that the fact does not have.

        A row is the same if its partition and its fingerprint are. A batch that lacks columns has no fingerprints.
        """
        keys = staged.rows.select(S.ARTICLE_KEY, *PARTITION, FINGERPRINT)
        holding = _distinct_partitions(self.locate(keys.select(S.ARTICLE_KEY), staged.row_count))
        if not holding:
            return {}, staged.rows
        own = keys.select(S.ARTICLE_KEY, *[F.col(name).alias(f"new_{name}") for name in HIDDEN])
        held = self.spark.table(self.name(S.FACT)).where(_within(holding)).select(S.ARTICLE_KEY, *HIDDEN)
        same = [F.col(name) == F.col(f"new_{name}") for name in HIDDEN]
        alike = F.coalesce(same[0] & same[1] & same[2], F.lit(False)) if complete else F.lit(False)
        found = held.join(sized_keys(own, staged.row_count), S.ARTICLE_KEY).select(S.ARTICLE_KEY, *PARTITION, alike.alias("alike"))
        folder = f"{staged.folder}/held"
        self._write(found, folder)
        found = self.spark.read.schema(found.schema).parquet(folder)
        counts = found.groupBy("alike", *PARTITION).count().collect()
        staged.unchanged = sum(row["count"] for row in counts if row["alike"])
        replaced = {(row[PERIOD], row[SLICE]): row["count"] for row in counts if not row["alike"]}
        if not staged.unchanged:
            return replaced, staged.rows
        equal = sized_keys(found.where("alike").select(S.ARTICLE_KEY), staged.unchanged)
        return replaced, staged.rows.join(equal, S.ARTICLE_KEY, "left_anti").select(staged.rows.columns)

    def _write_companions(self, location: str, partitions: Iterable[Partition]) -> None:
        """Write what the companion tables hold of fact partitions whose files are at ``location``."""
        partitions = set(partitions)
        if not partitions:
            return

        def write(companion: Companion) -> None:
            rows = self._fact_files(location, [*companion.columns]).where(_within(partitions))
            self._write_in_partitions(companion.make(rows, *PARTITION), companion.folder(location), companion.order)

        companions = self.companions
        with ThreadPoolExecutor(len(companions)) as threads:
            list(threads.map(write, companions))

    def _complete_companions(self) -> None:
        """Make what the companion tables lack, as in a warehouse that was loaded before there were any."""
        partitions = self.partitions()
        for companion in self.companions:
            self.ensure_table(companion.table, companion.schema, companion.description, PARTITION_SCHEMA)
            present = self.partitions(companion.table)
            missing = partitions - present
            if missing:
                location = self._new_folder(S.FACT)
                rows = self.spark.table(self.name(S.FACT)).where(_within(missing)).select(*companion.columns, *PARTITION)
                self._write_in_partitions(companion.make(rows, *PARTITION), location, companion.order)
                self._set_locations(companion.table, [(*partition, _folder(location, partition)) for partition in missing])
            if present - partitions:
                self._set_locations(companion.table, [(*partition, None) for partition in present - partitions])

    def _period_bytes(
        self, staged: StagedBatch, added: Mapping[Partition, int], replaced: Mapping[Partition, int]
    ) -> dict[int, float]:
        """Bytes that each period of a batch will have: its files in the fact and those of the batch, less replaced
        rows, which are taken to be as long as those of the batch."""
        rows, old = Counter(), Counter()
        for counts, by_partition in ((rows, added), (old, replaced)):
            for (period, _), count in by_partition.items():
                counts[period] += count
        locations = partition_locations(self.spark, self.database, S.FACT)
        stored = [(int(location.rsplit(f"/{PERIOD}=", 1)[1].split("/")[0]), location) for location in locations]
        batch = self._folder_bytes([(period, _folder(staged.location_of((period, part)), (period, part))) for period, part in added])
        fact = self._folder_bytes([(period, location) for period, location in stored if period in rows])
        return {period: fact[period] + batch[period] * max(0.0, 1 - old[period] / rows[period]) for period in rows}

    def _folder_bytes(self, folders: list[tuple[int, str]]) -> Counter[int]:
        sizes: Counter[int] = Counter()
        with ThreadPoolExecutor(CATALOG_THREADS) as threads:
            measured = threads.map(lambda folder: stored_bytes(self.spark, folder[1]), folders)
            for (period, _), size in zip(folders, measured, strict=True):
                sizes[period] += size
        return sizes

    def mark_missing(
        self,
        ids: DataFrame,
        as_of: datetime,
        max_delete_fraction: float | None = None,
        digests: DataFrame | None = None,
        ids_within: Callable[[list[tuple[int, int]]], DataFrame] | None = None,
    ) -> int:
        """Mark active fact rows whose id the source no longer has; returns their number.

        Digests by range of the ids that the source holds as not deleted, which it may compute itself (``digests``), are
        compared with those of active rows, which are stored with the fact. Ranges that differ, also for changes not loaded
        yet, are compared by key: of the fact, keys and flags of partitions with keys in these ranges are read, and with
        ``ids_within`` only ids of these ranges from the source. Full rows are read where a key is missing.
        """
        self.make_ready()
        fact, bitmaps = self.spark.table(self.name(S.FACT)), self.table(S.KEYS)
        folder = self._new_folder(S.FACT)
        try:
            held = bitmaps.groupBy("key_range").agg(*[F.sum(name).alias(name) for name in ("keys", "digest_a", "digest_b")])
            differing = differing_ranges(held, digests if digests is not None else key_digests(ids))
            self._write(differing, f"{folder}/ranges")
            ranges = self.spark.read.schema(differing.schema).parquet(f"{folder}/ranges")
            size = ranges.agg(F.count(F.lit(1)).alias("ranges"), F.sum("keys").alias("keys")).first()
            if not size["ranges"]:
                return 0
            wanted = sized_keys(ranges.select("key_range"), size["ranges"])
            if ids_within and size["ranges"] <= RANGE_READS:
                ids = ids_within(id_spans(row["key_range"] for row in ranges.select("key_range").collect()))
            near = F.col("key_range"), key_range(F.col(S.ARTICLE_KEY))
            ids = ids.withColumn("key_range", near[1]).join(wanted, "key_range", "left_semi").drop("key_range")
            touched = _distinct_partitions(self.spark.table(self.name(S.KEYS)).join(wanted, "key_range", "left_semi"))
            slim = fact.where(_within(touched)).select(S.ARTICLE_KEY, "is_deleted", *PARTITION)
            slim = slim.withColumn("key_range", near[1]).join(wanted, "key_range", "left_semi").drop("key_range")
            found = missing_from_source(slim, ids).select(S.ARTICLE_KEY, *PARTITION)
            self._write(found, f"{folder}/missing")
            missing = self.spark.read.schema(found.schema).parquet(f"{folder}/missing")
            count = missing.count()
            if not count:
                return 0
            if max_delete_fraction is not None:
                active = held.agg(F.sum("keys").alias("keys")).first()["keys"]
                if count > max_delete_fraction * active:
                    raise DeleteGuardError(f"{count} of {active} active rows are missing from the source")
            touched = _distinct_partitions(missing)
            flags = sized_keys(missing.withColumn("missing", F.lit(True)), count)
            rows = fact.where(_within(touched)).join(flags, [S.ARTICLE_KEY, *PARTITION], "left")
            gone = F.col("missing") & (F.col("is_deleted") == F.lit(False))
            location = self._new_folder(S.FACT)
            # With few keys the rows are still as the files of their partitions hold them.
            self._write_fact(mark_deleted(rows, gone, as_of).select(*fact.columns), location, in_files=count <= BROADCAST_KEYS)
            self._write_companions(location, touched)
            self._publish({partition: _folder(location, partition) for partition in touched}, set())
            return count
        finally:
            delete_folder(self.spark, folder)

    def _write(self, rows: DataFrame, location: str) -> None:
        rows.write.mode("errorifexists").parquet(location)

    def _write_fact(self, placed: DataFrame, location: str, in_files: bool = False) -> None:
        """Write fact rows with a fingerprint of what they hold now.

        With ``in_files`` the rows are read from files of the fact, so those of a task are of few partitions: each task
        writes its own, and none is shuffled.
        """
        size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        before = self.spark.conf.get(size)
        self.spark.conf.set(size, str(self.file_bytes))
        data = [name for name in placed.columns if name not in HIDDEN]
        printed = placed.select(*data, row_fingerprint(data).alias(FINGERPRINT), *PARTITION)
        try:
            self._write_in_partitions(printed, location, CLUSTERING, BLOOM, dealt=not in_files)
        finally:
            self.spark.conf.set(size, before)

    def _write_in_partitions(
        self, placed: DataFrame, location: str, order: Iterable[str], options: Mapping[str, str] = {}, dealt: bool = True
    ) -> None:
        # Rebalancing splits a partition with many rows over several tasks and joins small ones,
        # which a repartition by the same columns would not.
        rows = placed.hint("rebalance", *PARTITION) if dealt else placed
        rows = rows.sortWithinPartitions(*PARTITION, *order)
        rows.write.mode("errorifexists").options(**options).partitionBy(*PARTITION).parquet(location)

    def _fact_files(self, location: str, columns: list[str]) -> DataFrame:
        """Stored fact rows, without hidden columns that are not asked for."""
        fields = {field.name: field for field in self.spark.table(self.name(S.FACT)).schema}
        schema = T.StructType([fields[name] for name in columns if name not in PARTITION])
        for field in PARTITION_SCHEMA:
            schema = schema.add(field)
        return self.spark.read.schema(schema).parquet(location)

    # Publication

    def partitions(self, table: str = S.FACT) -> set[Partition]:
        """Partitions of the fact or of a table beside it, from the catalog."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        return {tuple(int(part.split("=")[1]) for part in row["partition"].split("/")) for row in listed}

    def _publish(
        self, published: dict[Partition, str], dropped: set[Partition], properties: Mapping[str, str] = {}
    ) -> None:
        """Point the catalog at new partition folders and remove partitions left empty.

        Each statement is atomic, their sequence is not. The list is stored first, and setting the
        table property commits it: from then on it is carried out, by a later run if need be.
        ``properties`` are set in the statement that commits.
        """
        entries = [(*partition, location) for partition, location in published.items()]
        entries += [(*partition, None) for partition in dropped]
        plan = self._new_folder("publication")
        schema = T.StructType([*PARTITION_SCHEMA, T.StructField("location", T.StringType())])
        self._write(self.spark.createDataFrame(entries, schema).coalesce(1), plan)
        self._set_properties({**properties, _PENDING: plan, _AUTHORS_BEHIND: "yes"})
        self._carry_out(entries)
        self._set_properties({_PENDING: ""})
        delete_folder(self.spark, plan)

    def make_ready(self) -> None:
        """Finish an interrupted publication, and make what the tables beside the fact lack."""
        self.finish_publication()
        self._complete_companions()

    def finish_publication(self) -> None:
        """Carry out a committed publication that was interrupted."""
        plan = self._properties(S.FACT).get(_PENDING)
        if plan:
            self._carry_out([tuple(row) for row in self.spark.read.parquet(plan).collect()])
            self._set_properties({_PENDING: ""})
            delete_folder(self.spark, plan)

    def _carry_out(self, entries: list[tuple[int, int, str | None]]) -> None:
        def move(companion: Companion) -> None:
            beside = [(period, part, location and companion.beside(location)) for period, part, location in entries]
            self._set_locations(companion.table, beside)

        companions = self.companions
        with ThreadPoolExecutor(len(companions)) as threads:
            list(threads.map(move, companions))
        self._set_locations(S.FACT, entries)

    def _set_locations(self, table: str, entries: list[tuple[int, int, str | None]]) -> None:
        """Point the catalog at partition folders, and drop partitions without one."""
        existing = self.partitions(table)
        alter = self._alter_fact if table == S.FACT else lambda change: self._alter(table, change)
        moved, added, dropped = [], [], []
        for period, part, location in entries:
            spec = f"PARTITION ({PERIOD} = {period}, {SLICE} = {part})"
            if location is None:
                dropped.append(spec)
            elif (period, part) in existing:
                moved.append(f"{spec} SET LOCATION {_quoted(location)}")
            else:
                added.append(f"{spec} LOCATION {_quoted(location)}")
        for start in range(0, len(added), 500):
            alter("ADD IF NOT EXISTS " + " ".join(added[start : start + 500]))
        # Statements of their own, which a remote catalog answers one by one.
        with ThreadPoolExecutor(CATALOG_THREADS) as threads:
            list(threads.map(alter, moved))
        if dropped:
            alter("DROP IF EXISTS " + ", ".join(dropped))

    def _alter_fact(self, change: str) -> None:
        self._alter(S.FACT, change)

    def _alter(self, table: str, change: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} {change}")

    def note(self, name: str) -> dict | None:
        """What is noted with the fact under ``name``, or None."""
        text = self._properties(S.FACT).get(f"note.{name}")
        return json.loads(text) if text else None

    @staticmethod
    def noted(name: str, value: dict | None) -> dict[str, str]:
        """Table properties that note ``value`` under ``name``; None removes it."""
        return {f"note.{name}": json.dumps(value) if value else ""}

    def forget(self, name: str) -> None:
        self._set_properties(self.noted(name, None))

    def _properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {row["key"]: row["value"] for row in rows}

    def _set_properties(self, properties: Mapping[str, str]) -> None:
        if not properties:
            return
        listed = ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in properties.items())
        self._alter_fact(f"SET TBLPROPERTIES ({listed})")

    # Folders

    def vacuum(self, older_than: timedelta = timedelta(days=7)) -> list[str]:
        """Delete run folders that no table points at; younger ones stay for running readers.

        A committed publication is carried out first, so that the folders it names are pointed at.
        """
        self.finish_publication()
        limit = utc_now() - older_than
        removed = []
        for table in (S.FACT, S.DATES, S.AUTHORS, S.CONTROL):
            used = self._runs_in_use(table)
            for run in subfolders(self.spark, f"{self.root}/{table}"):
                if run not in used and _run_time(run) is not None and _run_time(run) <= limit:
                    removed.append(f"{self.root}/{table}/{run}")
        for folder in removed:
            delete_folder(self.spark, folder)
        return removed

    def _runs_in_use(self, table: str) -> set[str]:
        """Runs that wrote the current files of a table, from the locations in the catalog."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        locations = [described.where(F.col("col_name") == "Location").first()["data_type"]]
        if table == S.FACT:
            beside = [c.table for c in self.companions if self.spark.catalog.tableExists(self.name(c.table))]
            for name in (table, *beside):
                locations += partition_locations(self.spark, self.database, name)
        return {location.rstrip("/").split(f"/{table}/")[-1].split("/")[0] for location in locations}


def _folder(location: str, partition: Partition) -> str:
    return f"{location}/{PERIOD}={partition[0]}/{SLICE}={partition[1]}"


def _run_time(run: str) -> datetime | None:
    try:
        return datetime.strptime(run.split("-")[0], "%Y%m%dT%H%M%S")
    except ValueError:
        return None
