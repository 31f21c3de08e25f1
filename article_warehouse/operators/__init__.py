from article_warehouse.operators.authors import author_dimension
from article_warehouse.operators.calendar import covering_calendar, date_dimension, key_outliers
from article_warehouse.operators.keys import differing_ranges, key_bitmaps, key_digests, located
from article_warehouse.operators.merge import (
    DuplicateKeyError,
    duplicate_keys,
    keep_latest,
    merge_upsert,
    missing_from_source,
    reconcile_deletes,
    require_unique,
)
from article_warehouse.operators.rollup import article_rollup, authors_of_rollup, merged_rollup
from article_warehouse.operators.scans import (
    changed_between,
    created_between,
    keyset_page,
    source_ids,
)
from article_warehouse.operators.transform import transform_articles
from article_warehouse.operators.windows import (
    batch_plan,
    time_windows,
    window_groups,
    window_index,
    window_totals,
)

__all__ = [
    "DuplicateKeyError",
    "article_rollup",
    "author_dimension",
    "authors_of_rollup",
    "batch_plan",
    "changed_between",
    "created_between",
    "covering_calendar",
    "date_dimension",
    "differing_ranges",
    "duplicate_keys",
    "keep_latest",
    "key_bitmaps",
    "key_digests",
    "key_outliers",
    "keyset_page",
    "located",
    "merge_upsert",
    "merged_rollup",
    "missing_from_source",
    "reconcile_deletes",
    "require_unique",
    "source_ids",
    "time_windows",
    "transform_articles",
    "window_groups",
    "window_index",
    "window_totals",
]
