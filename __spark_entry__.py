"""

All queries run over an ``articles`` view of the ``documents`` table (see
``article_warehouse/sources/documents.py``). The load jobs run in a new warehouse below the
folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from article_warehouse import operators as op, plans, schemas as S
from article_warehouse.files import stored_bytes
from article_warehouse.functions import instant
from article_warehouse.operators.calendar import calendar_days
from article_warehouse.scratch import scratch_folder
from article_warehouse.sources import FrameSource, article_source, articles_from_documents

try:  # these may be left out of a build
    import corpus_pipeline
    from article_warehouse.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "article_warehouse.llm"):
        raise
    llm = None

# Times of the scenario: start of history, backfill, end of the next interval, delete sync, end of all changes.
START = datetime(2016, 1, 1)
BACKFILLED = datetime(2023, 6, 1)
CHANGED_UNTIL = datetime(2024, 6, 1)
SYNCED = datetime(2026, 1, 1)
END = datetime(2026, 5, 22)
# The upsert query alone: its target ends later than its batch begins.
TARGET_END = datetime(2024, 1, 1)
CHUNK_DAYS, BATCH_SIZE, PAGE_SIZE = 31, 5000, 500
PAGE_AFTER = (datetime(2019, 1, 1), 0)


# Inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(_table(spark, sf_dir, "documents"))


def revised_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).withColumn("title", F.concat("title", F.lit("-v2")))


def remaining_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source after toxic articles that had been loaded were removed from it."""
    toxic = _table(spark, sf_dir, "labels").where("toxic = 1").select((F.col("doc_id") + 1).alias("toxic_id"))
    rows = articles(spark, sf_dir)
    gone = (F.col("id") == F.col("toxic_id")) & (F.col("updated_at") < instant(CHANGED_UNTIL))
    return rows.join(toxic, gone, "left_anti")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.transform_articles(articles(spark, sf_dir))


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.author_dimension(fact(spark, sf_dir), SYNCED)


# Operators


def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.changed_between(articles(spark, sf_dir), BACKFILLED, CHANGED_UNTIL)


def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.created_between(articles(spark, sf_dir), START, BACKFILLED)


def history_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.window_totals(articles(spark, sf_dir), START, END, CHUNK_DAYS, BATCH_SIZE)


def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.keyset_page(articles(spark, sf_dir), START, END, PAGE_SIZE, PAGE_AFTER)


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.batch_plan(articles(spark, sf_dir), START, END, 365, 20)


def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.source_ids(articles(spark, sf_dir))


def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the days that the articles span."""
    created = F.col("created_at").cast("date")
    span = articles(spark, sf_dir).agg(F.min(created).alias("first_day"), F.max(created).alias("last_day"))
    return calendar_days(span)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys read twice: history and the later changes overlap, and together they are all articles."""
    return op.duplicate_keys(_read_twice(spark, sf_dir))


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read_twice(spark, sf_dir)
    repeated = op.duplicate_keys(rows)
    return op.keep_latest(rows, repeated=(repeated, repeated.count()))


def _read_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = op.created_between(articles(spark, sf_dir), START, TARGET_END)
    return op.transform_articles(history).unionByName(_changed_rows(spark, sf_dir))


def _changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.transform_articles(op.changed_between(revised_articles(spark, sf_dir), BACKFILLED, END))


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = op.transform_articles(op.created_between(articles(spark, sf_dir), START, TARGET_END))
    batch = _changed_rows(spark, sf_dir)
    return op.merge_upsert(target, batch, batch_rows=batch.count())


def missing_from_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = op.source_ids(remaining_articles(spark, sf_dir))
    return op.missing_from_source(fact(spark, sf_dir), ids).select("article_id", "author_id", "updated_at")


def reconcile_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = op.source_ids(remaining_articles(spark, sf_dir))
    missing = op.missing_from_source(fact(spark, sf_dir).select("article_id", "is_deleted"), ids).count()
    return op.reconcile_deletes(fact(spark, sf_dir), ids, SYNCED, missing_rows=missing)


# Load jobs, each in a warehouse of its own


def _warehouse(spark: SparkSession, sf_dir: str, years: tuple[int, int] = op.calendar.PLAUSIBLE_YEARS) -> plans.Warehouse:
    name = f"article_warehouse_{uuid.uuid4().hex[:12]}"
    size = stored_bytes(spark, f"{sf_dir}/documents.parquet")
    layout = plans.Layout.for_articles(articles(spark, sf_dir), size)
    return plans.Warehouse(spark, f"{scratch_folder(spark)}/{name}", name, layout, years=years)


def _backfilled(spark: SparkSession, sf_dir: str) -> plans.Warehouse:
    warehouse = _warehouse(spark, sf_dir)
    plans.run_backfill(FrameSource(articles(spark, sf_dir)), warehouse, BACKFILLED)
    return warehouse


def _updated(spark: SparkSession, sf_dir: str, until: datetime) -> plans.Warehouse:
    warehouse = _backfilled(spark, sf_dir)
    source = FrameSource(revised_articles(spark, sf_dir))
    plans.run_incremental(source, warehouse, BACKFILLED, until, until)
    return warehouse


_HOURLY: dict[tuple[str, str], tuple[plans.Warehouse, dict[str, int | None]]] = {}


def _hourly(spark: SparkSession, sf_dir: str) -> plans.Warehouse:
    return _hourly_run(spark, sf_dir)[0]


def _hourly_run(spark: SparkSession, sf_dir: str) -> tuple[plans.Warehouse, dict[str, int | None]]:
    """A warehouse after backfill, changes and an hourly run that loads the rest and syncs deletes.

    Its three tables are read by queries of their own, so it is loaded once per application and source.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HOURLY:
        warehouse = _updated(spark, sf_dir, CHANGED_UNTIL)
        source = FrameSource(remaining_articles(spark, sf_dir))
        options = {"chunk_days": CHUNK_DAYS, "max_delete_fraction": 0.5}
        _HOURLY[key] = warehouse, plans.run_hourly(source, warehouse, CHANGED_UNTIL, END, SYNCED, **options)
    return _HOURLY[key]


def backfill_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfilled(spark, sf_dir).table(S.FACT)


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir, END).table(S.FACT)


def delete_sync_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir).table(S.FACT)


def authors_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir).table(S.AUTHORS)


def key_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the key bitmaps of a backfilled fact say that labelled articles are, without a look at the fact."""
    warehouse = _backfilled(spark, sf_dir)
    labelled = _table(spark, sf_dir, "labels").select((F.col("doc_id") + 1).cast("string").alias(S.ARTICLE_KEY)).distinct()
    return warehouse.locate(labelled, labelled.count()).select(S.ARTICLE_KEY, "created_period")


def replayed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last window of the hourly run does when it is loaded again: all its rows are there, nothing is published."""
    rows = remaining_articles(spark, sf_dir)
    batch = op.transform_articles(op.changed_between(rows, CHANGED_UNTIL, END))
    warehouse = _hourly(spark, sf_dir)
    with warehouse.staged(batch) as staged:
        warehouse.merge_staged(staged)
        counts = [("reported", staged.row_count), ("unchanged", staged.unchanged), ("published", len(staged.published))]
    return spark.createDataFrame(counts, "measure string, value long")


def differing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of ids in which active articles and those left in the source differ, from digests of both sides."""
    mine = op.key_digests(fact(spark, sf_dir).where("is_deleted = false"))
    return op.differing_ranges(mine, FrameSource(remaining_articles(spark, sf_dir)).id_digests())


def stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.merged_rollup(_hourly(spark, sf_dir).table(S.ROLLUP))


def _stored_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    warehouse = _hourly(spark, sf_dir)
    return warehouse.table(S.ROLLUP), warehouse.table(S.DATES), warehouse.table(S.AUTHORS)


def stored_year_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, dates, _ = _stored_star(spark, sf_dir)
    return plans.quarters_of_rollup(rollup, dates)


def stored_author_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, _, authors_ = _stored_star(spark, sf_dir)
    return plans.active_authors_of_rollup(rollup, authors_)


def stored_author_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, dates, _ = _stored_star(spark, sf_dir)
    return plans.weekends_of_rollup(rollup, dates)


def stored_author_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.author_years_of_rollup(*_stored_star(spark, sf_dir))


KNOWN_YEARS = (2016, 2030)


def quarantined_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days beyond the calendar's years, from the table beside a stored fact that lists their articles."""
    warehouse = _warehouse(spark, sf_dir, KNOWN_YEARS)
    plans.run_backfill(FrameSource(articles(spark, sf_dir)), warehouse, END)
    return plans.outlier_days(warehouse.table(S.OUTLIERS), warehouse.years)


def star_unknown_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles per quarter where the calendar lacks the last years: those are counted as well."""
    rows = fact(spark, sf_dir)
    return plans.articles_per_quarter(rows, op.covering_calendar(rows, years=KNOWN_YEARS))


def affected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of the hourly run reports."""
    counts = _hourly_run(spark, sf_dir)[1]
    return spark.createDataFrame(list(counts.items()), "step string, affected long")


def added_column_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a fact that got a column after its backfill; rows of the merge lack it."""
    warehouse = _backfilled(spark, sf_dir)
    warehouse.add_missing_columns(S.FACT, T.StructType([T.StructField("note", T.StringType())]))
    warehouse.merge_fact(warehouse.table(S.FACT).withColumn("note", F.concat(F.lit("n"), "article_id")))
    warehouse.merge_fact(_changed_rows(spark, sf_dir))
    return warehouse.table(S.FACT)


def article_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles read from a Parquet folder that has a column more."""
    folder = f"{scratch_folder(spark)}/articles-{uuid.uuid4().hex[:12]}"
    articles(spark, sf_dir).withColumn("extra", F.lit(1)).write.parquet(folder)
    return article_source(spark, folder).rows()


def control_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.control_records(_hourly(spark, sf_dir).table(S.CONTROL))


# Audits and star queries


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = op.date_dimension(spark)
    return plans.audit_counts(articles(spark, sf_dir), fact(spark, sf_dir), dates, authors(spark, sf_dir))


def stored_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts over the stored tables after the hourly run."""
    warehouse = _hourly(spark, sf_dir)
    tables = [warehouse.table(name) for name in (S.FACT, S.DATES, S.AUTHORS)]
    return plans.audit_counts(articles(spark, sf_dir), *tables)


def stored_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir).table(S.DATES)


def stored_article_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of one article, read from its slice of the stored fact."""
    return plans.article_state(_hourly(spark, sf_dir).article("2"), "2")


def facts_without_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date keys of the fact that a calendar of the usual years lacks."""
    return plans.facts_without_day(fact(spark, sf_dir), op.date_dimension(spark))


def source_id_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.source_id_count(op.source_ids(remaining_articles(spark, sf_dir)))


def article_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.article_state(reconcile_deletes(spark, sf_dir), "2")


def star_year_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact(spark, sf_dir)
    return plans.articles_per_quarter(rows, op.covering_calendar(rows))


def star_author_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.active_articles_per_author(fact(spark, sf_dir), authors(spark, sf_dir))


def star_author_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact(spark, sf_dir)
    return plans.weekend_share_per_author(rows, op.covering_calendar(rows))


def star_author_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact(spark, sf_dir)
    return plans.articles_per_author_year(rows, op.covering_calendar(rows), authors(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    return star_author_year(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "fact_articles": fact,
        "incremental_window": incremental_window,
        "history_scan": history_scan,
        "history_windows": history_windows,
        "keyset_page": keyset_page,
        "batch_plan": batch_plan,
        "source_ids": source_ids,
        "dim_dates": dim_dates,
        "dim_authors": authors,
        "duplicate_keys": duplicate_keys,
        "latest_rows": latest_rows,
        "merge_upsert": merge_upsert,
        "missing_from_source": missing_from_source,
        "reconcile_deletes": reconcile_deletes,
        "backfill_load": backfill_load,
        "incremental_load": incremental_load,
        "delete_sync_load": delete_sync_load,
        "authors_after_run": authors_after_run,
        "control_after_run": control_after_run,
        "affected_rows": affected_rows,
        "key_locations": key_locations,
        "replayed_window": replayed_window,
        "differing_ranges": differing_ranges,
        "stored_rollup": stored_rollup,
        "stored_year_quarter": stored_year_quarter,
        "stored_author_active": stored_author_active,
        "stored_author_weekend": stored_author_weekend,
        "stored_author_year": stored_author_year,
        "quarantined_days": quarantined_days,
        "star_unknown_day": star_unknown_day,
        "added_column_load": added_column_load,
        "article_source_rows": article_source_rows,
        "audit_counts": audit_counts,
        "stored_audit_counts": stored_audit_counts,
        "stored_calendar": stored_calendar,
        "stored_article_state": stored_article_state,
        "facts_without_day": facts_without_day,
        "source_id_count": source_id_count,
        "article_state": article_state,
        "star_year_quarter": star_year_quarter,
        "star_author_active": star_author_active,
        "star_author_weekend": star_author_weekend,
        "star_author_year": star_author_year,
        **({**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}),
    }


# The same in SQL


def _at(value: datetime) -> str:
    return f"timestamp '{value}'"


_ARTICLES = """
timed as (
  select *, timestamp '2016-01-01' + to_hours(cast(doc_id * 7919 % 87600 as integer)) as created
  from documents
),
articles as (
  select
    cast(doc_id + 1 as bigint) as id,
    lang || '-' || source || '-' || doc_id as title,
    case when doc_id % 50 <> 7 then text end as content,
    case when doc_id % 11 <> 3 then created + to_hours(case when doc_id % 13 = 4 then 87601 else 1 end) end as published_at,
    case when doc_id % 37 <> 5 then cast(regexp_extract(source, '([0-9]+)$', 1) as bigint) + 101 end as author_id,
    created as created_at,
    created + to_hours(cast(doc_id % 72 as integer)) as updated_at,
    case when doc_id % 8 = 0 then created + to_hours(cast(doc_id % 72 as integer)) end as deleted_at
  from timed
)"""

# Every blank of Unicode by its number.
_WORD = (
    r"[^\x{9}\x{a}\x{b}\x{c}\x{d}\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _key(column: str) -> str:
    return f"cast(strftime({column} + interval 7 hour, '%Y%m%d') as bigint)"


def _fact_sql(source: str, title: str = "title") -> str:
    return f"""
  select
    cast(id as varchar) as article_key, cast(id as varchar) as article_id, author_id,
    {_key("published_at")} as published_date_key, {_key("created_at")} as created_date_key,
    coalesce({title}, '') as title, coalesce(content, '') as content,
    cast(len(regexp_extract_all(coalesce(content, ''), '{_WORD}')) as bigint) as word_count,
    cast(length(coalesce(content, '')) as bigint) as char_count,
    published_at, created_at, updated_at, deleted_at, deleted_at is not null as is_deleted
  from {source}"""


def _calendar(first: str, last: str) -> str:
    return f"""
  select
    cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(d as date) as date_actual,
    cast(year(d) as bigint) as year, cast(quarter(d) as bigint) as quarter, cast(month(d) as bigint) as month,
    monthname(d) as month_name, cast(day(d) as bigint) as day, cast(isodow(d) as bigint) as day_of_week,
    dayname(d) as day_name, isodow(d) in (6, 7) as is_weekend
  from (select unnest(range(cast({first} as timestamp), cast({last} as timestamp) + interval 1 day, interval 1 day)) as d)"""


def _authors_sql(source: str, as_of: datetime) -> str:
    return f"""
  select
    author_id, cast(author_id as varchar) as author_key, 'author_' || cast(author_id as varchar) as author_name,
    min(created_at) as first_article_created_at, max(updated_at) as last_article_updated_at,
    count(*) as total_article_count, count(*) filter (where is_deleted = false) as active_article_count,
    {_at(as_of)} as updated_at
  from {source} where author_id is not null group by author_id"""


def _reconciled_sql(source: str) -> str:
    return f"""
  select
    f.article_key, f.article_id, f.author_id, f.published_date_key, f.created_date_key, f.title, f.content,
    f.word_count, f.char_count, f.published_at, f.created_at,
    case when r.article_id is null and f.is_deleted = false then {_at(SYNCED)} else f.updated_at end as updated_at,
    case when r.article_id is null and f.is_deleted = false
      then coalesce(f.deleted_at, {_at(SYNCED)}) else f.deleted_at end as deleted_at,
    case when r.article_id is null and f.is_deleted = false then true else f.is_deleted end as is_deleted
  from {source} f left join remaining r on r.article_id = f.article_id"""


_FACT = f"{_ARTICLES},\nfact as ({_fact_sql('articles')})"
_CHANGED = f"updated_at >= {_at(BACKFILLED)} and updated_at < {_at(CHANGED_UNTIL)}"
_REMAINING = f"""
remaining as (
  select cast(id as varchar) as article_id from articles
  where not (updated_at < {_at(CHANGED_UNTIL)} and id in (select doc_id + 1 from labels where toxic = 1))
)"""
_DATES = f"dates as ({_calendar(repr(op.calendar.FIRST_DATE), repr(op.calendar.LAST_DATE))})"
# Without a calendar: what day a publication fell on, at the zone's offset.
_PUBLISHED = "published as (select *, published_at + interval 7 hour as day from fact where published_at is not null)"
_AUTHORS = f"authors as ({_authors_sql('fact', SYNCED)})"
_WINDOWS = f"""
windows as (
  select i as window_index, {_at(START)} + to_days(cast(i * {CHUNK_DAYS} as integer)) as window_start,
    least({_at(START)} + to_days(cast((i + 1) * {CHUNK_DAYS} as integer)), {_at(END)}) as window_end
  from (select unnest(range(0, {-((START - END).days // CHUNK_DAYS)})) as i)
)"""


def _revised(until: datetime, name: str) -> str:
    changed = f"updated_at >= {_at(BACKFILLED)} and updated_at < {_at(until)}"
    return f"{name} as ({_fact_sql(f'(select * from articles where {changed})', repr('') + ' || title || ' + repr('-v2'))})"


def _merged(name: str, target: str, batch: str) -> str:
    return f"{name} as (select * from {target} where article_id not in (select article_id from {batch}) union all select * from {batch})"


_BATCH = _revised(END, "batch")
_BACKFILL = f"history as (select * from fact where created_at >= {_at(START)} and created_at < {_at(BACKFILLED)})"
_LOADED = f"""{_FACT},
{_BATCH},
{_BACKFILL},
{_merged("loaded", "history", "batch")},
{_revised(CHANGED_UNTIL, "first_batch")},
{_merged("updated", "history", "first_batch")},
{_REMAINING},
rest as (
  select f.* from fact f join remaining using (article_id)
  where f.updated_at >= {_at(CHANGED_UNTIL)} and f.updated_at < {_at(END)}
),
{_merged("all_rows", "updated", "rest")},
final as ({_reconciled_sql("all_rows")})"""
_READ_TWICE = f"""{_FACT},
{_BATCH},
both_reads as (
  select * from fact where created_at >= {_at(START)} and created_at < {_at(TARGET_END)}
  union all select * from batch
)"""


# From ``fact``, ``published`` and ``authors``.
_STAR = {
        "star_year_quarter": """
select cast(year(day) as bigint) as year, cast(quarter(day) as bigint) as quarter, count(*) as articles,
  cast(sum(word_count) as bigint) as words, cast(sum(word_count) as double) / count(*) as mean_words
from published group by 1, 2""",
        "star_author_active": """
select author_id, author_name, first_article_created_at, count(*) as active_articles,
  cast(sum(word_count) as bigint) as active_words
from fact join authors using (author_id) where is_deleted = false
group by author_id, author_name, first_article_created_at""",
        "star_author_weekend": """
select author_id, count(*) as articles, count(*) filter (where isodow(day) > 5) as weekend_articles,
  cast(count(*) filter (where isodow(day) > 5) as double) / count(*) as weekend_share
from published where author_id is not null group by author_id""",
        "star_author_year": """
select author_id, author_name, cast(year(day) as bigint) as year, count(*) as articles,
  count(*) filter (where is_deleted = false) as active_articles, cast(sum(word_count) as bigint) as words
from published join authors using (author_id) group by 1, 2, 3 order by 1, 3""",
}
# The same names over the stored fact after the hourly run.
_STORED = f"fact as (with {_LOADED} select * from final), {_AUTHORS}, {_PUBLISHED}"


def _control_sql() -> str:
    batches = f"""
  select coalesce(sum(cast(ceil(n / {BATCH_SIZE}.0) as bigint)), 0) as batches
  from (select count(*) as n from history
        group by floor(date_diff('second', {_at(START)}, created_at) / {CHUNK_DAYS * 86400}))"""
    return f"""with {_LOADED}, batch_total as ({batches})
select 'articles_historical_backfill' as process_name, 'completed' as state, {_at(BACKFILLED)} as watermark,
  {_at(BACKFILLED)} as last_success_at,
  '{{"rows_loaded": ' || (select count(*) from history) || ', "batches_loaded": ' || (select cast(batches as bigint) from batch_total)
  || ', "source_start": "{START}+00:00", "source_end": "{BACKFILLED}+00:00"}}' as details
union all
select 'articles_incremental_watermark', 'completed', {_at(END)}, {_at(SYNCED)},
  '{{"rows_loaded": ' || (select count(*) from rest)
  || ', "window_start": "{CHANGED_UNTIL}+00:00", "window_end": "{END}+00:00"}}'"""


def oracle_sql() -> dict[str, str]:
    star = f"with {_FACT}, {_DATES}, {_AUTHORS}, {_PUBLISHED}\n"
    usual = f"{op.calendar.FIRST_DATE.replace('-', '')} and {op.calendar.LAST_DATE.replace('-', '')}"
    last_day = f"greatest(date '{op.calendar.LAST_DATE}', (select cast(max(greatest(published_at, created_at)) + interval 7 hour as date) from final))"
    history = f"created_at >= {_at(START)} and created_at < {_at(END)}"
    return {
        "fact_articles": f"with {_FACT} select * from fact",
        "incremental_window": f"with {_ARTICLES} select * from articles where {_CHANGED}",
        "history_scan": f"with {_ARTICLES} select * from articles where created_at >= {_at(START)} and created_at < {_at(BACKFILLED)}",
        "history_windows": f"""with {_ARTICLES}, {_WINDOWS}
select window_index, window_start, window_end, count(id) as row_count,
  cast(ceil(count(id) / {BATCH_SIZE}.0) as bigint) as batch_count
from windows left join articles on created_at >= window_start and created_at < window_end
group by window_index, window_start, window_end""",
        "keyset_page": f"""with {_ARTICLES}
select * from articles
where {history} and (created_at > {_at(PAGE_AFTER[0])} or (created_at = {_at(PAGE_AFTER[0])} and id > {PAGE_AFTER[1]}))
order by created_at, id limit {PAGE_SIZE}""",
        "batch_plan": f"""with {_ARTICLES},
windowed as (
  select id, created_at, cast(floor(date_diff('second', {_at(START)}, created_at) / {365 * 86400}) as bigint) as window_index
  from articles where {history}
)
select id, created_at, window_index,
  cast(floor((row_number() over (partition by window_index order by created_at, id) - 1) / 20) as bigint) as batch_index
from windowed""",
        "source_ids": f"with {_ARTICLES} select cast(id as varchar) as article_id from articles",
        "dim_dates": f"with {_ARTICLES} {_calendar('(select min(cast(created_at as date)) from articles)', '(select max(cast(created_at as date)) from articles)')}",
        "dim_authors": f"with {_FACT}, {_AUTHORS} select * from authors",
        "duplicate_keys": f"""with {_READ_TWICE}
select article_id, count(*) as row_count from both_reads group by article_id having count(*) > 1""",
        "latest_rows": f"""with {_READ_TWICE}
select * exclude (place) from (
  select *, row_number() over (partition by article_id order by updated_at desc, title desc) as place from both_reads
) where place = 1""",
        "merge_upsert": f"""with {_FACT}, {_BATCH}
select * from fact where created_at >= {_at(START)} and created_at < {_at(TARGET_END)}
  and article_id not in (select article_id from batch)
union all select * from batch""",
        "missing_from_source": f"""with {_FACT}, {_REMAINING}
select article_id, author_id, updated_at from fact
where is_deleted = false and article_id not in (select article_id from remaining)""",
        "reconcile_deletes": f"with {_FACT}, {_REMAINING} {_reconciled_sql('fact')}",
        "backfill_load": f"with {_FACT}, {_BACKFILL} select * from history",
        "incremental_load": f"with {_LOADED} select * from loaded",
        "delete_sync_load": f"with {_LOADED} select * from final",
        "authors_after_run": f"with {_LOADED} {_authors_sql('final', SYNCED)}",
        "control_after_run": _control_sql(),
        "affected_rows": f"""with {_LOADED}
select 'backfilled' as step, 0 as affected
union all select 'changed', (select count(*) from rest)
union all select 'marked_deleted', (
  select count(*) from all_rows where not is_deleted and article_id not in (select article_id from remaining))""",
        "key_locations": f"""with {_LOADED}
select article_id, cast(year(created_at) as integer) as created_period from history
where article_id in (select cast(doc_id + 1 as varchar) from labels)""",
        "replayed_window": f"""with {_LOADED}
select 'reported' as measure, count(*) as value from rest
union all select 'unchanged', count(*) from rest union all select 'published', 0""",
        "differing_ranges": f"""with {_FACT}, {_REMAINING},
mine as (
  select (cast(article_id as bigint) - 1) // 32768 as key_range, count(*) as keys, list(article_id order by article_id) as ids
  from fact where is_deleted = false group by 1
),
theirs as (
  select (cast(article_id as bigint) - 1) // 32768 as key_range, count(*) as keys, list(article_id order by article_id) as ids
  from fact where is_deleted = false and article_id in (select article_id from remaining) group by 1
)
select key_range, mine.keys + coalesce(theirs.keys, 0) as keys from mine left join theirs using (key_range)
where mine.ids is distinct from theirs.ids""",
        "stored_rollup": f"""with {_LOADED}
select author_id, published_date_key, count(*) as articles, count(*) filter (where is_deleted = false) as active_articles,
  cast(sum(word_count) as bigint) as words,
  cast(coalesce(sum(word_count) filter (where is_deleted = false), 0) as bigint) as active_words,
  min(created_at) as first_created_at, max(updated_at) as last_updated_at
from final group by author_id, published_date_key""",
        **{name.replace("star", "stored", 1): f"with {_STORED} {sql}" for name, sql in _STAR.items()},
        "quarantined_days": f"""with {_FACT}
select 'published_date_key' as date_column, published_date_key as date_key, count(*) as row_count from fact
where published_date_key not between {KNOWN_YEARS[0]}0000 and {KNOWN_YEARS[1]}1231
  and created_at >= {_at(START)} and created_at < {_at(END)} group by published_date_key""",
        "star_unknown_day": f"""{star}
select cast(year(known) as bigint) as year, cast(quarter(known) as bigint) as quarter, count(*) as articles,
  cast(sum(word_count) as bigint) as words, cast(sum(word_count) as double) / count(*) as mean_words
from (select word_count, case when day < timestamp '{KNOWN_YEARS[1] + 1}-01-01' then day end as known from published)
group by 1, 2""",
        "added_column_load": f"""with {_LOADED}
select loaded.*, case when article_id in (select article_id from history) then 'n' || article_id end as note from loaded""",
        "article_source_rows": f"with {_ARTICLES} select * from articles",
        "audit_counts": f"""{star}
select 'source_rows' as check_name, count(*) as row_count from articles
union all select 'fact_rows', count(*) from fact
union all select 'deleted_rows', count(*) filter (where is_deleted) from fact
union all select 'date_rows', count(*) from dates
union all select 'author_rows', count(*) from authors""",
        "stored_audit_counts": f"""with {_LOADED}
select 'source_rows' as check_name, count(*) as row_count from articles
union all select 'fact_rows', count(*) from final
union all select 'deleted_rows', count(*) filter (where is_deleted) from final
union all select 'date_rows', date_diff('day', date '{op.calendar.FIRST_DATE}', {last_day}) + 1
union all select 'author_rows', count(distinct author_id) from final""",
        "stored_calendar": f"with {_LOADED} {_calendar(repr(op.calendar.FIRST_DATE), last_day)}",
        "stored_article_state": f"""with {_LOADED}
select article_id, is_deleted, deleted_at from final where article_id = '2'""",
        "facts_without_day": f"""with {_FACT}
select date_key, count(*) as row_count
from (select published_date_key as date_key from fact union all select created_date_key from fact)
where date_key not between {usual} group by date_key""",
        "source_id_count": f"with {_ARTICLES}, {_REMAINING} select count(*) as source_ids from remaining",
        "article_state": f"""with {_FACT}, {_REMAINING}, final as ({_reconciled_sql("fact")})
select article_id, is_deleted, deleted_at from final where article_id = '2'""",
        **{name: f"{star} {sql}" for name, sql in _STAR.items()},
        **(llm.oracle_sql() if llm else {}),
    }
