"""Control table: state and high-water mark of each process."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from article_warehouse.functions import instant, utc_naive, utc_now
from article_warehouse.operators.merge import merge_upsert
from article_warehouse.plans.warehouse import Warehouse
from article_warehouse.schemas import CONTROL, CONTROL_SCHEMA


def details_text(details: Mapping[str, Any] | None) -> str:
    """Run details as JSON text, with times as text that carries the UTC offset."""

    def plain(value: Any) -> Any:
        if isinstance(value, datetime):
            return str(utc_naive(value).replace(tzinfo=timezone.utc))
        return value

    # What JSON has no form for becomes text.
    return json.dumps({name: plain(value) for name, value in (details or {}).items()}, default=str)


def control_entry(
    spark: SparkSession,
    process: str,
    state: str,
    watermark: datetime | None = None,
    details: Mapping[str, Any] | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """One control row; ``last_success_at`` is set whatever the state."""
    values = {
        "process_name": F.lit(process),
        "state": F.lit(state),
        "watermark": instant(watermark) if watermark is not None else F.lit(None),
        "last_success_at": instant(at if at is not None else utc_now()),
        "details": F.lit(details_text(details)),
    }
    columns = [values[field.name].cast(field.dataType).alias(field.name) for field in CONTROL_SCHEMA]
    return spark.range(1, numPartitions=1).select(*columns)


def upsert_control(
    warehouse: Warehouse,
    process: str,
    state: str,
    watermark: datetime | None = None,
    details: Mapping[str, Any] | None = None,
    at: datetime | None = None,
) -> None:
    """Insert or overwrite the record of one process."""
    entry = control_entry(warehouse.spark, process, state, watermark, details, at)
    records = merge_upsert(warehouse.table(CONTROL), entry, key="process_name")
    # One row per process.
    warehouse.replace_table(CONTROL, records.coalesce(1))


def control_record(warehouse: Warehouse, process: str) -> Row | None:
    """The record of one process, or None."""
    return warehouse.table(CONTROL).where(F.col("process_name") == process).limit(1).first()


def control_mark(warehouse: Warehouse, process: str) -> datetime | None:
    """The high-water mark of one process, or None."""
    record = control_record(warehouse, process)
    return record["watermark"] if record else None
