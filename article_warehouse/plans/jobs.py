"""Load jobs over a source and a warehouse.

A high-water mark moves only after the data is published. A job that stops in between runs its
window again, and the upsert makes the repetition harmless.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from article_warehouse.functions import utc_naive, utc_now
from article_warehouse.functions.times import BUSINESS_ZONE
from article_warehouse.operators.transform import transform_articles
from article_warehouse.operators.windows import window_groups, window_totals
from article_warehouse.plans.control import control_mark, control_record, upsert_control
from article_warehouse.plans.warehouse import Warehouse
from article_warehouse.schemas import (
    AFTER_BACKFILL,
    AFTER_EARLIER_BACKFILL,
    BACKFILL_PROCESS,
    COMPLETED,
    INCREMENTAL_PROCESS,
    RUNNING,
)
from article_warehouse.sources import FrameSource, JdbcSource

# Start of history and default sizes.
HISTORY_START = datetime(2016, 1, 1)
CHUNK_DAYS = 31
BATCH_SIZE = 5000
# Rows that a backfill publishes at a time; a failure costs no more than that.
GROUP_ROWS = 1_000_000_000

Source = FrameSource | JdbcSource

_LEDGER = "backfill"


def run_backfill(
    source: Source,
    warehouse: Warehouse,
    as_of: datetime | None = None,
    start: datetime = HISTORY_START,
    chunk_days: int = CHUNK_DAYS,
    batch_size: int = BATCH_SIZE,
    on_duplicate: str | None = None,
    zone: str = BUSINESS_ZONE,
    with_authors: bool = True,
    group_rows: int = GROUP_ROWS,
) -> int:
    """Load all history from ``start`` to now once; returns the number of rows loaded.

    The mark left for incremental loads is the time at which the backfill began, so rows that
    change while it runs are read again. ``batch_size`` sizes the reported batches; the load
    itself is one job for each group of windows with about ``group_rows`` rows. The statement that commits a group
    notes how far the backfill has come, so a run after a failure goes on behind the last one, with the time and the
    counts of the run that failed, unless it is given other windows or batches. ``on_duplicate`` handles repeated keys; by default it is
    what the source recommends. ``with_authors`` is off where a later job refreshes the author dimension.
    """
    warehouse.bootstrap()
    done = control_record(warehouse, BACKFILL_PROCESS)
    if done and done["state"] == COMPLETED:
        if control_mark(warehouse, INCREMENTAL_PROCESS) is None:
            upsert_control(
                warehouse,
                INCREMENTAL_PROCESS,
                COMPLETED,
                done["watermark"],
                {"source": AFTER_EARLIER_BACKFILL},
                as_of,
            )
        return 0

    began, start = utc_naive(as_of) if as_of else utc_now(), utc_naive(start)
    sizes = {"chunk_days": chunk_days, "batch_size": batch_size}
    loaded, batches, come = 0, 0, start
    terms = {**sizes, "start": start.isoformat(), "zone": zone}
    ledger = warehouse.note(_LEDGER) if done and done["state"] == RUNNING else None
    if ledger and ledger["terms"] == terms:
        began, come = (datetime.fromisoformat(ledger[name]) for name in ("began", "until"))
        loaded, batches = ledger["rows"], ledger["batches"]
    upsert_control(warehouse, BACKFILL_PROCESS, RUNNING, began, sizes, as_of)

    rows = source.window_rows(come, began, chunk_days) if come < began else {}
    for first, until in window_groups(rows, come, began, chunk_days, group_rows):
        batch = transform_articles(source.created(first, until, chunk_days), zone)
        with warehouse.staged(batch, on_duplicate or source.on_duplicate) as staged:
            totals = (
                window_totals(staged.rows, start, began, chunk_days, batch_size)
                .agg(F.sum("row_count").alias("rows"), F.sum("batch_count").alias("batches"))
                .first()
            )
            loaded, batches = loaded + (totals["rows"] or 0), batches + (totals["batches"] or 0)
            entry = {"terms": terms, "began": began.isoformat(), "until": until.isoformat(), "rows": loaded, "batches": batches}
            warehouse.merge_staged(staged, warehouse.noted(_LEDGER, entry))
    if with_authors:
        warehouse.catch_up_authors(as_of or utc_now())

    summary = {
        "rows_loaded": loaded,
        "batches_loaded": batches,
        "source_start": start,
        "source_end": began,
    }
    upsert_control(warehouse, BACKFILL_PROCESS, COMPLETED, began, summary, as_of)
    seed = {"source": AFTER_BACKFILL}
    upsert_control(warehouse, INCREMENTAL_PROCESS, COMPLETED, began, seed, as_of)
    warehouse.forget(_LEDGER)
    return loaded


def run_incremental(
    source: Source,
    warehouse: Warehouse,
    interval_start: datetime,
    interval_end: datetime,
    as_of: datetime | None = None,
    lookback: timedelta = timedelta(0),
    on_duplicate: str | None = None,
    zone: str = BUSINESS_ZONE,
    with_authors: bool = True,
) -> int | None:
    """Load rows changed since the mark, up to the end of the interval; returns their number.

    Returns None if the mark is already there. ``lookback`` reads a stretch before the mark again,
    for sources whose transactions may commit late. An empty window moves the mark all the same.
    """
    warehouse.bootstrap()
    mark = control_mark(warehouse, INCREMENTAL_PROCESS) or utc_naive(interval_start)
    end = utc_naive(interval_end)
    if mark >= end:
        return None

    batch = transform_articles(source.changed(mark - lookback, end), zone)
    loaded = warehouse.merge_fact(batch, on_duplicate or source.on_duplicate)
    if with_authors:
        warehouse.catch_up_authors(as_of or utc_now())
    summary = {"rows_loaded": loaded, "window_start": mark, "window_end": end}
    upsert_control(warehouse, INCREMENTAL_PROCESS, COMPLETED, end, summary, as_of)
    return loaded


def run_delete_sync(
    source: Source,
    warehouse: Warehouse,
    as_of: datetime | None = None,
    max_delete_fraction: float | None = None,
    with_authors: bool = True,
) -> int:
    """Mark rows that are gone from the source as deleted; returns their number.

    An empty source marks every active row. ``max_delete_fraction`` stops the job instead when
    more than that share of the active rows would be marked. The source is asked for digests of its ids
    by range, then for the ids of ranges that differ.
    """
    warehouse.bootstrap()
    now = utc_naive(as_of) if as_of else utc_now()
    marked = warehouse.mark_missing(source.ids(), now, max_delete_fraction, source.id_digests(), source.ids_within)
    if with_authors:
        warehouse.catch_up_authors(as_of or utc_now())
    return marked


def run_hourly(
    source: Source,
    warehouse: Warehouse,
    interval_start: datetime,
    interval_end: datetime,
    as_of: datetime | None = None,
    *,
    start: datetime = HISTORY_START,
    chunk_days: int = CHUNK_DAYS,
    batch_size: int = BATCH_SIZE,
    on_duplicate: str | None = None,
    zone: str = BUSINESS_ZONE,
    lookback: timedelta = timedelta(0),
    max_delete_fraction: float | None = None,
    group_rows: int = GROUP_ROWS,
) -> dict[str, int | None]:
    """Bootstrap, backfill, incremental load and delete sync in this order; a failure stops the rest.

    The options are those of the single jobs. The author dimension, which takes a scan of the fact, is refreshed
    once, after the last step or the one that failed, if a step changed rows.
    """
    warehouse.bootstrap()
    try:
        return {
            "backfilled": run_backfill(
                source, warehouse, as_of, start, chunk_days, batch_size, on_duplicate, zone, False, group_rows
            ),
            "changed": run_incremental(
                source, warehouse, interval_start, interval_end, as_of, lookback, on_duplicate, zone, False
            ),
            "marked_deleted": run_delete_sync(source, warehouse, as_of, max_delete_fraction, False),
        }
    finally:
        warehouse.catch_up_authors(as_of or utc_now())
