from datetime import date, datetime, timedelta

import pytest
from conftest import article, frame, sorted_rows
from pyspark.sql import functions as F

from article_warehouse import operators as op, schemas as S
from article_warehouse.sources import FrameSource, articles_from_documents

DAY = datetime(2020, 1, 1)


def test_transform_gives_the_fact_schema(spark):
    fact = op.transform_articles(frame(spark, [article(1, DAY)]))
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in S.FACT_SCHEMA]
    empty = op.transform_articles(frame(spark, []))
    assert empty.schema.names == S.FACT_SCHEMA.names and empty.count() == 0


def test_transform_of_incomplete_rows(spark):
    rows = [
        (1, None, None, None, None, None, None, None),
        (2, "T", "two words", datetime(2016, 12, 17, 17), 5, DAY, DAY, DAY),
    ]
    first, second = op.transform_articles(frame(spark, rows)).orderBy("article_id").collect()
    assert first.asDict() == {
        **dict.fromkeys(S.FACT_SCHEMA.names),
        "article_key": "1", "article_id": "1", "title": "", "content": "",
        "word_count": 0, "char_count": 0, "is_deleted": False,
    }
    assert (second.word_count, second.char_count, second.is_deleted) == (2, 9, True)
    assert (second.published_date_key, second.created_date_key) == (20161218, 20200101)


def test_transform_of_text_columns(spark):
    raw = spark.createDataFrame(
        [("7", "T", "c", "2016-12-18 07:00:00+07", "101.0", "2016-12-18 07:00:00+07", "bad", "never")],
        "id string, title string, content string, published_at string, author_id string, "
        "created_at string, updated_at string, deleted_at string",
    )
    row = op.transform_articles(raw).first()
    assert (row.article_id, row.author_id) == ("7", 101)
    assert row.created_at == datetime(2016, 12, 18) and row.updated_at is None
    # A deletion time that cannot be read counts as not deleted.
    assert row.deleted_at is None and row.is_deleted is False


def test_transform_is_one_projection(spark, tmp_path):
    frame(spark, [article(1, DAY)]).write.parquet(f"{tmp_path}/a")
    plan = _plan(op.transform_articles(spark.read.parquet(f"{tmp_path}/a")))
    assert "Exchange" not in plan and "Python" not in plan


def test_calendar(spark, zone):
    dates = op.date_dimension(spark)
    assert dates.count() == 5844
    assert [(f.name, f.dataType) for f in dates.schema] == [(f.name, f.dataType) for f in S.DATES_SCHEMA]
    assert tuple(dates.orderBy("date_key").first()) == (
        20150101, date(2015, 1, 1), 2015, 1, 1, "January", 1, 4, "Thursday", False,
    )
    for row in dates.where("day = 30 or is_weekend").collect():
        day = row.date_actual
        assert row.date_key == int(day.strftime("%Y%m%d"))
        assert (row.month_name, row.day_name) == (day.strftime("%B"), day.strftime("%A"))
        assert row.day_of_week == day.isoweekday() and row.is_weekend == (day.isoweekday() > 5)
    assert op.date_dimension(spark, "2011-12-30", "2011-12-30").first().day_name == "Friday"
    assert op.date_dimension(spark, "2020-01-02", "2020-01-01").count() == 0


@pytest.mark.parametrize(("days", "count"), [(31, 123), (1, 3794), (4000, 1), (3794, 1), (3793, 2)])
def test_windows_are_disjoint_and_cover_the_range(spark, days, count):
    start, end = datetime(2016, 1, 1), datetime(2026, 5, 22)
    rows = op.time_windows(spark, start, end, days).orderBy("window_index").collect()
    assert len(rows) == count
    assert rows[0].window_start == start and rows[-1].window_end == end
    assert all(a.window_end == b.window_start for a, b in zip(rows, rows[1:]))
    assert all(r.window_end - r.window_start == timedelta(days=days) for r in rows[:-1])


def test_windows_of_an_empty_range(spark):
    assert op.time_windows(spark, DAY, DAY, 31).count() == 0
    assert op.time_windows(spark, DAY, DAY - timedelta(days=40), 31).count() == 0
    with pytest.raises(ValueError):
        op.time_windows(spark, DAY, DAY, 0)


def _spread(spark, count=500, ties=4):
    """Articles of which ``ties`` share each creation time."""
    return frame(spark, [article(i + 1, DAY + timedelta(hours=7 * (i // ties))) for i in range(count)])


def test_reading_by_windows_equals_one_scan(spark):
    articles, end = _spread(spark), DAY + timedelta(days=30)
    windows = op.time_windows(spark, DAY, end, 7).collect()
    by_window = [r.id for w in windows for r in op.created_between(articles, w.window_start, w.window_end).collect()]
    assert sorted(by_window) == [r.id for r in op.created_between(articles, DAY, end).orderBy("id").collect()]
    totals = op.window_totals(articles, DAY, end, 7, 50)
    assert totals.agg(F.sum("row_count")).first()[0] == len(by_window)
    assert [tuple(r) for r in totals.orderBy("window_index").select("row_count", "batch_count").collect()] == [
        (96, 2), (96, 2), (96, 2), (96, 2), (28, 1),
    ]


def test_chained_pages_equal_the_sorted_scan(spark):
    articles, end = _spread(spark, 100).cache(), DAY + timedelta(days=7)
    expected = [(r.created_at, r.id) for r in op.created_between(articles, DAY, end).orderBy("created_at", "id").collect()]
    chained, cursor = [], None
    while page := op.keyset_page(articles, DAY, end, 17, cursor).collect():
        assert len(page) <= 17
        chained += [(r.created_at, r.id) for r in page]
        cursor = chained[-1]
    assert chained == expected


@pytest.mark.parametrize("ties", [1, 4, 500])
def test_batch_plan_numbers_each_window(spark, ties):
    articles = _spread(spark, 500, ties)
    plan = op.batch_plan(articles, DAY, DAY + timedelta(days=400), 7, 9).collect()
    expected, seen = {}, {}
    for r in sorted(articles.collect(), key=lambda r: (r.created_at, r.id)):
        window = (r.created_at - DAY).days // 7
        expected[r.id] = (window, seen.get(window, 0) // 9)
        seen[window] = seen.get(window, 0) + 1
    assert {r.id: (r.window_index, r.batch_index) for r in plan} == expected


def test_batch_plan_spreads_a_hot_window(spark):
    # All rows share one creation time; the sort still uses every task.
    articles = frame(spark, [article(i, DAY) for i in range(4000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = op.batch_plan(articles, DAY, DAY + timedelta(days=1), 1, 100)
        assert plan.agg(F.max("batch_index"), F.count("*")).first()[0:2] == (39, 4000)
        keys = articles.repartitionByRange("created_at", "id").withColumn("task", F.spark_partition_id())
        assert keys.groupBy("task").count().agg(F.max("count")).first()[0] < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_changed_between_is_half_open_and_ordered(spark):
    rows = [article(i, DAY, updated=DAY + timedelta(hours=i % 3)) for i in (5, 3, 1, 2, 4)]
    changed = op.changed_between(frame(spark, rows), DAY + timedelta(hours=1), DAY + timedelta(hours=2), ordered=True)
    assert [r.id for r in changed.collect()] == [1, 4]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_time_filters_agree_for_every_column_type(spark, zone, kind):
    rows = frame(spark, [article(i, datetime(2016, 11, 6) + timedelta(hours=i)) for i in range(24)])
    text = F.concat(F.col("created_at").cast("string"), F.lit("Z"))
    typed = rows.withColumn("created_at", rows.created_at if kind == "timestamp_ntz" else text.cast(kind))
    found = op.created_between(typed, datetime(2016, 11, 6, 5), datetime(2016, 11, 6, 8))
    assert sorted(r.id for r in found.collect()) == [5, 6, 7]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_time_filters_reach_the_scan(spark, tmp_path, kind):
    rows = frame(spark, [article(1, DAY)])
    rows.withColumn("created_at", F.col("created_at").cast(kind)).write.parquet(f"{tmp_path}/a")
    articles = FrameSource(spark.read.parquet(f"{tmp_path}/a"))
    plan = _plan(articles.created(DAY, DAY + timedelta(days=1), 31).select("id"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(created_at" in pushed and "LessThan(created_at" in pushed
    read = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "content" not in read and "title" not in read
    read = next(line for line in _plan(articles.ids()).splitlines() if "ReadSchema" in line)
    assert read.endswith("struct<id:bigint>")


def _fact(spark, *rows):
    return op.transform_articles(frame(spark, list(rows)))


def test_upsert_overwrites_and_inserts(spark):
    target = _fact(spark, article(1, DAY, title="a"), article(2, DAY, title="b"))
    batch = _fact(spark, article(2, DAY + timedelta(days=90), title="B"), article(3, DAY, title="c"))
    merged = op.merge_upsert(target, batch)
    assert merged.columns == target.columns
    assert sorted_rows(merged, "article_id", "title") == [("1", "a"), ("2", "B"), ("3", "c")]
    assert merged.where("article_id = '2'").first().created_at == DAY + timedelta(days=90)


def test_upsert_twice_equals_once(spark):
    target = _fact(spark, article(1, DAY), article(2, DAY))
    batch = _fact(spark, article(2, DAY, title="new"), article(3, DAY))
    once = op.merge_upsert(target, batch)
    assert sorted_rows(op.merge_upsert(once, batch)) == sorted_rows(once)


def test_an_older_batch_wins(spark):
    target = _fact(spark, article(1, DAY, title="new", updated=DAY + timedelta(days=9)))
    batch = _fact(spark, article(1, DAY, title="old"))
    assert op.merge_upsert(target, batch).first().title == "old"


def test_upsert_removes_every_old_copy_of_a_key(spark):
    target = _fact(spark, article(1, DAY), article(1, DAY + timedelta(days=40)))
    assert op.merge_upsert(target, _fact(spark, article(1, DAY, title="x"))).count() == 1


def test_upsert_keeps_columns_that_the_batch_lacks(spark):
    target = _fact(spark, article(1, DAY), article(2, DAY)).withColumn("note", F.concat(F.lit("n"), "article_id"))
    batch = _fact(spark, article(2, DAY, title="B"), article(3, DAY, title="C"))
    merged = op.merge_upsert(target, batch)
    assert sorted_rows(merged, "article_id", "title", "note") == [
        ("1", "Title", "n1"), ("2", "B", "n2"), ("3", "C", None),
    ]


def test_upsert_keeps_named_columns_of_matched_rows(spark):
    target = _fact(spark, article(1, DAY), article(2, DAY)).withColumn("article_key", F.lit("first"))
    batch = _fact(spark, article(2, DAY), article(3, DAY))
    merged = op.merge_upsert(target, batch, keep=["article_key"])
    assert sorted_rows(merged, "article_id", "article_key") == [("1", "first"), ("2", "first"), ("3", "3")]


def test_upsert_restores_a_deleted_row(spark):
    fact = _fact(spark, article(1, DAY))
    deleted = op.reconcile_deletes(fact, spark.createDataFrame([], "article_id string"), DAY)
    assert deleted.first().is_deleted is True
    assert op.merge_upsert(deleted, fact).first().is_deleted is False


def test_reconcile_marks_only_missing_active_rows(spark):
    now = datetime(2026, 1, 1)
    fact = _fact(
        spark,
        article(1, DAY),
        article(2, DAY),
        article(3, DAY, deleted=DAY),
        article(4, DAY),
    ).withColumn("is_deleted", F.when(F.col("article_id") != "4", F.col("is_deleted")))
    # Repeated ids and ids that the fact does not know change nothing.
    ids = spark.createDataFrame([("1",), ("1",), ("9",)], "article_id string")
    assert sorted_rows(op.missing_from_source(fact, ids), "article_id") == [("2",)]
    after = op.reconcile_deletes(fact, ids, now)
    assert after.columns == fact.columns
    assert sorted_rows(after, "article_id", "is_deleted", "deleted_at", "updated_at") == [
        ("1", False, None, DAY),
        ("2", True, now, now),
        ("3", True, DAY, DAY),
        ("4", None, None, DAY),
    ]


def test_reconcile_keeps_a_known_deletion_time(spark):
    fact = _fact(spark, article(1, DAY, deleted=DAY)).withColumn("is_deleted", F.lit(False))
    row = op.reconcile_deletes(fact, spark.createDataFrame([], "article_id string"), datetime(2026, 1, 1)).first()
    assert (row.is_deleted, row.deleted_at, row.updated_at) == (True, DAY, datetime(2026, 1, 1))


def test_reconcile_with_all_ids_changes_nothing(spark):
    fact = _fact(spark, article(1, DAY), article(2, DAY, deleted=DAY))
    assert sorted_rows(op.reconcile_deletes(fact, fact.select("article_id"), DAY)) == sorted_rows(fact)


def test_repeated_keys(spark):
    batch = _fact(spark, article(1, DAY), article(1, DAY, title="new", updated=DAY + timedelta(days=1)), article(2, DAY))
    assert sorted_rows(op.duplicate_keys(batch)) == [("1", 2)]
    with pytest.raises(op.DuplicateKeyError, match="1 .2 rows"):
        op.require_unique(batch)
    latest = op.keep_latest(batch)
    assert latest.columns == batch.columns
    assert sorted_rows(latest, "article_id", "title") == [("1", "new"), ("2", "Title")]
    op.require_unique(latest)


def test_author_dimension(spark):
    later = DAY + timedelta(days=3)
    fact = _fact(
        spark,
        article(1, DAY, 7),
        article(2, later, 7, deleted=later),
        article(3, DAY, None),
        article(4, later, 8),
    ).withColumn("is_deleted", F.when(F.col("article_id") != "4", F.col("is_deleted")))
    authors = op.author_dimension(fact, datetime(2026, 1, 1))
    assert [(f.name, f.dataType) for f in authors.schema] == [(f.name, f.dataType) for f in S.AUTHORS_SCHEMA]
    assert [tuple(r) for r in authors.orderBy("author_id").collect()] == [
        (7, "7", "author_7", DAY, later, 2, 1, datetime(2026, 1, 1)),
        # A missing flag is not active.
        (8, "8", "author_8", later, later, 1, 0, datetime(2026, 1, 1)),
    ]


def test_aggregates_combine_before_the_shuffle(spark):
    plan = _plan(op.author_dimension(op.transform_articles(frame(spark, [])), DAY))
    assert "partial_count" in plan and "partial_min" in plan


def test_articles_view_of_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    articles = articles_from_documents(documents)
    assert [(f.name, f.dataType) for f in articles.schema] == [(f.name, f.dataType) for f in S.ARTICLES_SCHEMA]
    counts = articles.agg(
        F.count("*"), F.count("deleted_at"), F.count("author_id"), F.count("published_at"), F.count("content"),
        F.countDistinct("author_id"), F.min("created_at"), F.max("created_at"),
    ).first()
    assert tuple(counts) == (200, 25, 194, 182, 196, 20, datetime(2016, 1, 1), datetime(2025, 12, 11, 4))


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
