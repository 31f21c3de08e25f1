from article_warehouse.plans.audits import article_state, audit_counts, control_records, facts_without_day, outlier_days, source_id_count
from article_warehouse.plans.control import control_mark, control_record, upsert_control
from article_warehouse.plans.jobs import run_backfill, run_delete_sync, run_hourly, run_incremental
from article_warehouse.plans.star import (
    active_articles_per_author,
    active_authors_of_rollup,
    articles_per_author_year,
    articles_per_quarter,
    author_years_of_rollup,
    quarters_of_rollup,
    weekend_share_per_author,
    weekends_of_rollup,
)
from article_warehouse.plans.warehouse import DeleteGuardError, Layout, Warehouse

__all__ = [
    "DeleteGuardError",
    "Layout",
    "Warehouse",
    "active_articles_per_author",
    "active_authors_of_rollup",
    "article_state",
    "articles_per_author_year",
    "articles_per_quarter",
    "audit_counts",
    "author_years_of_rollup",
    "control_mark",
    "control_record",
    "control_records",
    "facts_without_day",
    "outlier_days",
    "quarters_of_rollup",
    "run_backfill",
    "run_delete_sync",
    "run_hourly",
    "run_incremental",
    "source_id_count",
    "upsert_control",
    "weekend_share_per_author",
    "weekends_of_rollup",
]
