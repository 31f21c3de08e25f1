"""Table schemas and process names.

A timestamp inside the warehouse is TIMESTAMP_NTZ holding UTC wall time, so no
result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLES = "articles"
FACT = "fact_articles"
DATES = "dim_dates"
AUTHORS = "dim_authors"
CONTROL = "etl_control"
# Kept with the fact, one partition for each of its partitions.
KEYS = "fact_article_keys"
ROLLUP = "fact_article_rollup"
OUTLIERS = "fact_article_outliers"

# Process names and states stored in the control table.
BACKFILL_PROCESS = "articles_historical_backfill"
INCREMENTAL_PROCESS = "articles_incremental_watermark"
RUNNING = "running"
COMPLETED = "completed"
# Why the control table holds a mark that no incremental load has set.
AFTER_BACKFILL = "historical_backfill_completion"
AFTER_EARLIER_BACKFILL = "historical_backfill_existing_state"

ARTICLE_KEY = "article_id"


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in REQUIRED) for name, kind in fields])


# Fixed values, down to the end: tables and columns that readers of the warehouse rely on.
# Columns that a warehouse row must have; files do not enforce it, so writers check it.
REQUIRED = {"id", "article_key", "article_id", "date_key", "author_key", "process_name"}

_LONG, _TEXT, _TIME = T.LongType(), T.StringType(), T.TimestampNTZType()

ARTICLES_SCHEMA = _struct(
    ("id", _LONG),
    ("title", _TEXT),
    ("content", _TEXT),
    ("published_at", _TIME),
    ("author_id", _LONG),
    ("created_at", _TIME),
    ("updated_at", _TIME),
    ("deleted_at", _TIME),
)

FACT_SCHEMA = _struct(
    ("article_key", _TEXT),
    ("article_id", _TEXT),
    ("author_id", _LONG),
    ("published_date_key", _LONG),
    ("created_date_key", _LONG),
    ("title", _TEXT),
    ("content", _TEXT),
    ("word_count", _LONG),
    ("char_count", _LONG),
    ("published_at", _TIME),
    ("created_at", _TIME),
    ("updated_at", _TIME),
    ("deleted_at", _TIME),
    ("is_deleted", T.BooleanType()),
)

KEYS_SCHEMA = _struct(
    ("key_range", _LONG),
    ("bitmap", T.BinaryType()),
    ("keys", _LONG),
    ("digest_a", _LONG),
    ("digest_b", _LONG),
)

ROLLUP_SCHEMA = _struct(
    ("author_id", _LONG),
    ("published_date_key", _LONG),
    ("articles", _LONG),
    ("active_articles", _LONG),
    ("words", _LONG),
    ("active_words", _LONG),
    ("first_created_at", _TIME),
    ("last_updated_at", _TIME),
)

OUTLIERS_SCHEMA = _struct(
    ("article_id", _TEXT),
    ("published_date_key", _LONG),
    ("created_date_key", _LONG),
)

DATES_SCHEMA = _struct(
    ("date_key", _LONG),
    ("date_actual", T.DateType()),
    ("year", _LONG),
    ("quarter", _LONG),
    ("month", _LONG),
    ("month_name", _TEXT),
    ("day", _LONG),
    ("day_of_week", _LONG),
    ("day_name", _TEXT),
    ("is_weekend", T.BooleanType()),
)

AUTHORS_SCHEMA = _struct(
    ("author_id", _LONG),
    ("author_key", _TEXT),
    ("author_name", _TEXT),
    ("first_article_created_at", _TIME),
    ("last_article_updated_at", _TIME),
    ("total_article_count", _LONG),
    ("active_article_count", _LONG),
    ("updated_at", _TIME),
)

CONTROL_SCHEMA = _struct(
    ("process_name", _TEXT),
    ("state", _TEXT),
    ("watermark", _TIME),
    ("last_success_at", _TIME),
    ("details", _TEXT),
)
