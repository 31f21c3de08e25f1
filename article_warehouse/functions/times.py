"""Time normalisation and business-zone date keys.

Everything here is independent of the session time zone: instants become TIMESTAMP_NTZ
values holding UTC wall time, and calendar dates are taken in an explicit zone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

BUSINESS_ZONE = "Asia/Jakarta"

# Anything after the time of day is a zone: "Z", "+07", "+07:00", "UTC", "Asia/Jakarta".
_MINUTES = r"^(\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2})"
_ZONED_TEXT = _MINUTES + r"(:\d{1,2}(\.\d*)?)?\s*[^\s\d.:]"
_ZONED_WITHOUT_SECONDS = _MINUTES + r"(?=\s*[^\s\d.:])"


def utc_naive(value: datetime | str) -> datetime:
    """A Python time as naive UTC; a value without zone counts as UTC already."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is None:
        return value
    return value.astimezone(timezone.utc).replace(tzinfo=None)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def instant(value: datetime | str, kind: T.DataType | None = None) -> Column:
    """A literal that compares with a time column of type ``kind`` without casting the column.

    Casting the column would keep the predicate out of the scan.
    """
    value = utc_naive(value)
    if isinstance(kind, T.TimestampType):
        micros = (value - datetime(1970, 1, 1)) // _MICROSECOND
        return F.timestamp_micros(F.lit(micros))
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


_MICROSECOND = datetime.resolution


def _wall_time_utc(zoned: Column) -> Column:
    # Adding elapsed microseconds to the epoch stays exact where a cast through the
    # session zone would lose an hour at a daylight-saving change.
    return F.timestamp_add("MICROSECOND", F.unix_micros(zoned), instant(datetime(1970, 1, 1)))


def to_utc(df: DataFrame, name: str) -> Column:
    """``df[name]`` as UTC wall time; text that is no time becomes null."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.TimestampType):
        return _wall_time_utc(column)
    if isinstance(kind, T.StringType):
        complete = F.regexp_replace(column, _ZONED_WITHOUT_SECONDS, "$1:00")
        return F.when(
            column.rlike(_ZONED_TEXT), _wall_time_utc(complete.try_cast("timestamp"))
        ).otherwise(column.try_cast("timestamp_ntz"))
    if isinstance(kind, T.NullType):
        return column.cast("timestamp_ntz")
    return column.try_cast("timestamp_ntz")


def date_key(utc: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Calendar date in ``zone`` as the integer yyyyMMdd; null stays null."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    return (F.year(local) * 10000 + F.month(local) * 100 + F.dayofmonth(local)).cast("bigint")
