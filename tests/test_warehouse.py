import random
from datetime import datetime, timedelta

import pytest
from conftest import article, clone, frame, new_warehouse, sorted_rows
from pyspark.sql import functions as F, types as T

from article_warehouse import operators as op, plans, schemas as S
from article_warehouse.files import subfolders
from article_warehouse.operators import merge
from article_warehouse.plans import warehouse as storage

DAY = datetime(2020, 1, 1)
NOW = datetime(2026, 1, 1)


def _fact(spark, *rows):
    return op.transform_articles(frame(spark, list(rows)))


def _titles(warehouse):
    return sorted_rows(warehouse.table(S.FACT), "article_id", "title")


@pytest.fixture(scope="module")
def four_articles(spark, tmp_path_factory):
    warehouse = new_warehouse(spark, tmp_path_factory.mktemp("stock"), plans.Layout("month", 3))
    warehouse.bootstrap()
    created = {1: DAY - timedelta(days=100), 2: DAY, 3: DAY, 4: DAY + timedelta(days=400)}
    assert warehouse.merge_fact(_fact(spark, *[article(i, t) for i, t in created.items()])) == 4
    return warehouse


@pytest.fixture
def stocked(four_articles, tmp_path):
    """A warehouse with article 1 in 2019, 2 and 3 in 2020, 4 in 2021."""
    return clone(four_articles, tmp_path)


def test_bootstrap_creates_the_tables_once(spark, warehouse):
    warehouse.bootstrap()
    for table, schema in {
        S.FACT: S.FACT_SCHEMA,
        S.DATES: S.DATES_SCHEMA,
        S.AUTHORS: S.AUTHORS_SCHEMA,
        S.CONTROL: S.CONTROL_SCHEMA,
    }.items():
        found = warehouse.table(table).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]
    assert warehouse.table(S.DATES).count() == 5844
    assert warehouse.table(S.FACT).count() == 0
    before = subfolders(spark, f"{warehouse.root}/{S.DATES}")
    warehouse.bootstrap()
    assert subfolders(spark, f"{warehouse.root}/{S.DATES}") == before
    described = spark.sql(f"describe table extended {warehouse.name(S.FACT)}").where("col_name = 'Comment'")
    assert described.first()["data_type"] == "Articles, one row per article_id"


def test_layout_is_that_of_the_existing_table(spark, warehouse):
    warehouse.bootstrap()
    other = plans.Warehouse(spark, warehouse.root, warehouse.database, plans.Layout("day", 4))
    other.bootstrap()
    assert other.layout == plans.Layout("year", 1)


def test_layout_follows_the_size():
    assert plans.Layout.for_bytes(1 << 30) == plans.Layout("year")
    assert plans.Layout.for_bytes(400 << 30) == plans.Layout("month")
    assert plans.Layout.for_bytes(100 << 40) == plans.Layout("day", 8)
    for wrong in (("week", 1), ("day", 0), ("day", 1, ((20200101, 0),))):
        with pytest.raises(ValueError):
            plans.Layout(*wrong)


def test_a_hot_period_gets_slices_of_its_own(spark, tmp_path):
    # A third of all rows share one creation time.
    rows = [article(i, DAY if i % 3 == 0 else DAY + timedelta(days=i)) for i in range(1, 301)]
    layout = plans.Layout.for_articles(frame(spark, rows), total=300 * 1000, per_partition=2400)
    assert layout.grain == "day" and layout.slices == 1
    assert layout.hot == ((20200101, 42),)
    # However many slices a period needs, it gets.
    assert plans.Layout.for_articles(frame(spark, rows), total=300 * 100_000, per_partition=2400).hot == ((20200101, 4167),)
    warehouse = new_warehouse(spark, tmp_path, plans.Layout("year", 2, ((2020, 16),)))
    warehouse.bootstrap()
    assert warehouse.layout == plans.Layout("year", 2, ((2020, 16),))
    warehouse.merge_fact(_fact(spark, *[article(i, DAY if i % 3 else DAY - timedelta(days=9)) for i in range(1, 61)]))
    parts = warehouse.partitions()
    assert {part for period, part in parts if period == 2019} == {0, 1}
    assert len({part for period, part in parts if period == 2020}) > 10
    # Rows move between periods with different numbers of slices.
    batch = [article(i, DAY if i % 3 == 0 else DAY - timedelta(days=9), title="moved") for i in (3, 4, 5, 6)]
    warehouse.merge_fact(_fact(spark, *batch))
    assert sorted_rows(warehouse.table(S.FACT).where("title = 'moved'"), "article_id") == [("3",), ("4",), ("5",), ("6",)]
    assert warehouse.table(S.FACT).count() == 60
    assert [warehouse.article(str(i)).count() for i in (3, 4, 7, 9, 61)] == [1, 1, 1, 1, 0]
    assert warehouse.mark_missing(spark.createDataFrame([("3",)], "article_id string"), NOW) == 59


def test_missing_columns_are_added_and_none_dropped(spark, stocked):
    wider = T.StructType([*S.FACT_SCHEMA.fields[:3], T.StructField("note", T.StringType())])
    assert stocked.add_missing_columns(S.FACT, wider) == ["note"]
    assert stocked.add_missing_columns(S.FACT, wider) == []
    assert stocked.table(S.FACT).columns == [*S.FACT_SCHEMA.names, "note"]
    assert stocked.table(S.FACT).where("note is null").count() == 4


def test_merge_after_a_column_was_added(spark, stocked):
    stocked.add_missing_columns(S.FACT, T.StructType([T.StructField("note", T.StringType())]))
    noted = stocked.table(S.FACT).withColumn("note", F.concat(F.lit("n"), "article_id"))
    stocked.merge_fact(noted)
    # Article 2 moves to another year; articles 5 opens a new one.
    stocked.merge_fact(_fact(spark, article(2, DAY + timedelta(days=800)), article(5, DAY + timedelta(days=1500))))
    assert sorted_rows(stocked.table(S.FACT), "article_id", "note") == [
        ("1", "n1"), ("2", "n2"), ("3", "n3"), ("4", "n4"), ("5", None),
    ]


def test_merge_updates_and_inserts(spark, stocked):
    stocked.merge_fact(_fact(spark, article(2, DAY, title="B"), article(5, DAY, title="E")))
    assert _titles(stocked) == [("1", "Title"), ("2", "B"), ("3", "Title"), ("4", "Title"), ("5", "E")]


def test_merge_rewrites_touched_partitions_only(spark, stocked):
    def folders():
        frame = spark.table(stocked.name(S.FACT))
        path = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        return dict(frame.select(*storage.PARTITION, path).distinct().rdd.map(lambda r: ((r[0], r[1]), r[2])).collect())

    before = folders()
    stocked.merge_fact(_fact(spark, article(2, DAY, title="B")))
    after = folders()
    assert before.keys() == after.keys()
    changed = {partition for partition in before if before[partition] != after[partition]}
    assert len(changed) == 1 and str(next(iter(changed))[0]).startswith("2020")


def test_merge_moves_a_row_between_partitions(spark, stocked):
    stocked.merge_fact(_fact(spark, article(2, DAY + timedelta(days=400), title="moved")))
    assert _titles(stocked) == [("1", "Title"), ("2", "moved"), ("3", "Title"), ("4", "Title")]


def test_merge_drops_an_emptied_partition(spark, stocked):
    count = len(stocked.partitions())
    stocked.merge_fact(_fact(spark, article(1, DAY + timedelta(days=400), title="moved")))
    assert ("1", "moved") in _titles(stocked) and len(_titles(stocked)) == 4
    assert not any(str(period).startswith("2019") for period, _ in stocked.partitions())
    assert len(stocked.partitions()) in (count - 1, count)


def test_merge_of_rows_without_creation_time(spark, stocked):
    stocked.merge_fact(_fact(spark, article(9, None, updated=DAY)))
    assert stocked.table(S.FACT).where("created_at is null").count() == 1
    assert any(period == 0 for period, _ in stocked.partitions())
    stocked.merge_fact(_fact(spark, article(9, DAY)))
    assert stocked.table(S.FACT).where("created_at is null").count() == 0
    assert not any(period == 0 for period, _ in stocked.partitions())
    assert len(_titles(stocked)) == 5


def test_merge_twice_equals_once(spark, stocked):
    batch = _fact(spark, article(2, DAY + timedelta(days=400), title="B"), article(5, DAY)).cache()
    stocked.merge_fact(batch)
    once = sorted_rows(stocked.table(S.FACT))
    stocked.merge_fact(batch)
    assert sorted_rows(stocked.table(S.FACT)) == once


def test_merge_equals_the_pure_operator(spark, stocked):
    before = stocked.table(S.FACT).cache()
    batch = _fact(spark, article(4, DAY, title="x"), article(6, DAY + timedelta(days=900)), article(1, DAY)).cache()
    expected = sorted_rows(op.merge_upsert(before, batch))
    stocked.merge_fact(batch)
    assert sorted_rows(stocked.table(S.FACT)) == expected


def test_large_key_sets_are_shuffled_instead_of_broadcast(spark, stocked, monkeypatch):
    monkeypatch.setattr(merge, "BROADCAST_KEYS", 0)
    before = stocked.table(S.FACT).cache()
    batch = _fact(spark, article(4, DAY, title="x"), article(6, DAY + timedelta(days=900))).cache()
    ids = spark.createDataFrame([("1",), ("4",), ("6",)], "article_id string")
    merged = op.merge_upsert(before, batch)
    expected = sorted_rows(op.reconcile_deletes(merged, ids, NOW))
    stocked.merge_fact(batch)
    assert stocked.mark_missing(ids, NOW) == 2
    assert sorted_rows(stocked.table(S.FACT)) == expected


def test_an_hourly_merge_shuffles_for_the_file_layout_only(spark, stocked):
    with stocked.staged(_fact(spark, article(2, DAY, title="B"))) as staged:
        fact = spark.table(stocked.name(S.FACT)).where(storage._within(staged_partitions(staged)))
        merged = op.merge_upsert(fact, staged.rows, batch_rows=staged.row_count)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert plan.count("PartitionFilters: [isnotnull(created_period") == 1


def staged_partitions(staged):
    return {tuple(row) for row in staged.rows.select(*storage.PARTITION).collect()}


def test_an_empty_batch_changes_nothing(spark, stocked):
    before = subfolders(spark, f"{stocked.root}/{S.FACT}")
    assert stocked.merge_fact(_fact(spark)) == 0
    assert subfolders(spark, f"{stocked.root}/{S.FACT}") == before


def test_repeated_keys_stop_a_merge(spark, stocked):
    batch = _fact(spark, article(2, DAY), article(2, DAY, title="new", updated=DAY + timedelta(days=1)))
    before, files = _titles(stocked), subfolders(spark, f"{stocked.root}/{S.FACT}")
    with pytest.raises(op.DuplicateKeyError):
        stocked.merge_fact(batch)
    assert _titles(stocked) == before and subfolders(spark, f"{stocked.root}/{S.FACT}") == files
    assert stocked.merge_fact(batch, on_duplicate="latest") == 1
    assert ("2", "new") in _titles(stocked)


def test_rows_without_key_stop_a_merge(spark, stocked):
    with pytest.raises(ValueError, match="have no article_id"):
        stocked.merge_fact(_fact(spark, article(2, DAY)).withColumn("article_id", F.lit(None).cast("string")))


def test_mark_missing(spark, stocked):
    ids = spark.createDataFrame([("1",), ("2",), ("4",)], "article_id string")
    expected = sorted_rows(op.reconcile_deletes(stocked.table(S.FACT), ids, NOW))
    assert stocked.mark_missing(ids, NOW) == 1
    assert sorted_rows(stocked.table(S.FACT)) == expected
    assert stocked.mark_missing(ids, NOW) == 0


def test_an_empty_source_marks_everything_unless_guarded(spark, stocked):
    nothing = spark.createDataFrame([], "article_id string")
    with pytest.raises(plans.DeleteGuardError):
        stocked.mark_missing(nothing, NOW, max_delete_fraction=0.5)
    assert stocked.table(S.FACT).where("is_deleted").count() == 0
    assert stocked.mark_missing(nothing, NOW) == 4
    assert stocked.table(S.FACT).where("is_deleted").count() == 4


def _large(first, last, day=DAY):
    return [article(i, day, title=f"t{i}", content=random.Random(i).randbytes(400).hex()) for i in range(first, last)]


def test_a_period_that_turns_hot_gets_more_slices(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path, plans.Layout("year", 1, partition_bytes=30_000))
    warehouse.bootstrap()
    other = DAY + timedelta(days=500)
    warehouse.merge_fact(_fact(spark, *_large(1, 4), *_large(900, 903, other)))
    assert warehouse.partitions() == {(2020, 0), (2021, 0)} and warehouse.layout.hot == ()
    batch = _fact(spark, *_large(2, 300)).cache()
    expected = sorted_rows(op.merge_upsert(warehouse.table(S.FACT).cache(), batch))
    files = set(warehouse.fact(other, other + timedelta(days=1)).inputFiles())
    warehouse.merge_fact(batch)
    assert sorted_rows(warehouse.table(S.FACT)) == expected
    ((period, slices),) = warehouse.layout.hot
    assert period == 2020 and slices > 1 and warehouse.layout.slices == 1
    assert {part for found, part in warehouse.partitions() if found == 2020} == set(range(slices))
    # The other period stays as it is, and each row is found in its slice.
    assert files == set(warehouse.fact(other, other + timedelta(days=1)).inputFiles())
    assert [warehouse.article(str(i)).first().title for i in (1, 2, 299, 900)] == ["t1", "t2", "t299", "t900"]
    warehouse.merge_fact(batch)
    assert sorted_rows(warehouse.table(S.FACT)) == expected and warehouse.layout.hot == ((2020, slices),)
    assert warehouse.mark_missing(spark.createDataFrame([("1",)], "article_id string"), NOW) == 301


@pytest.mark.parametrize("call", [1, 2, 3])
def test_a_crash_while_a_period_is_sliced_anew_loses_nothing(spark, tmp_path, monkeypatch, call):
    warehouse = new_warehouse(spark, tmp_path, plans.Layout("year", 1, partition_bytes=30_000))
    warehouse.bootstrap()
    warehouse.merge_fact(_fact(spark, *_large(1, 4)))
    batch = _fact(spark, *_large(2, 300)).cache()
    expected = sorted_rows(op.merge_upsert(warehouse.table(S.FACT).cache(), batch))
    with monkeypatch.context() as patched:
        _crash_at(patched, call)
        with pytest.raises(Crash):
            warehouse.merge_fact(batch)
    # The number of slices is committed with the publication.
    assert (warehouse.layout.hot == ()) == (call == 1)
    warehouse.bootstrap()
    warehouse.merge_fact(batch)
    assert sorted_rows(warehouse.table(S.FACT)) == expected
    assert warehouse.article("299").first().title == "t299"


def test_a_batch_for_a_new_period_gets_the_slices_it_needs(spark, stocked, tmp_path):
    warehouse = new_warehouse(spark, tmp_path, plans.Layout("month", 1, partition_bytes=30_000))
    warehouse.bootstrap()
    repeated = article(7, DAY, title="t7", updated=DAY + timedelta(days=1))
    assert warehouse.merge_fact(_fact(spark, *_large(1, 300), repeated), on_duplicate="latest") == 299
    ((period, slices),) = warehouse.layout.hot
    assert period == 202001 and len(warehouse.partitions()) == slices > 1
    assert warehouse.table(S.FACT).count() == 299


class Crash(Exception):
    pass


def _crash_at(monkeypatch, call):
    """Let the ``call``-th catalog change of the fact fail."""
    real, seen = plans.Warehouse._alter_fact, []

    def alter(self, change):
        seen.append(change)
        if len(seen) == call:
            raise Crash
        real(self, change)

    monkeypatch.setattr(plans.Warehouse, "_alter_fact", alter)


MOVES = [
    lambda: article(1, DAY + timedelta(days=400), title="x"),
    lambda: article(2, DAY + timedelta(days=800), title="x"),
    lambda: article(3, DAY, title="x"),
    lambda: article(7, DAY + timedelta(days=1600), title="x"),
]


@pytest.mark.parametrize("call", [1, 2, 3, 6])
def test_a_crash_between_any_two_steps_loses_nothing(spark, tmp_path, monkeypatch, call):
    warehouse = new_warehouse(spark, tmp_path)
    warehouse.bootstrap()
    warehouse.merge_fact(_fact(spark, *[article(i, DAY + timedelta(days=400 * (i // 2 - 1))) for i in range(1, 6)]))
    batch = _fact(spark, *[move() for move in MOVES]).cache()
    before = warehouse.table(S.FACT).select("*").cache()
    before.count()
    expected = sorted_rows(op.merge_upsert(before, batch))
    with monkeypatch.context() as patched:
        _crash_at(patched, call)
        with pytest.raises(Crash):
            warehouse.merge_fact(batch)
    # Rows outside the batch are there in any state.
    outside = warehouse.table(S.FACT).join(batch, "article_id", "left_anti")
    assert sorted_rows(outside, "article_id") == [("4",), ("5",)]
    if call == 1:
        # Nothing was committed: the old state is still there, and the window runs again.
        assert sorted_rows(warehouse.table(S.FACT)) == sorted_rows(before)
        warehouse.merge_fact(batch)
    else:
        warehouse.bootstrap()
    assert sorted_rows(warehouse.table(S.FACT)) == expected
    warehouse.merge_fact(batch)
    assert sorted_rows(warehouse.table(S.FACT)) == expected


def test_a_crash_while_files_are_written_leaves_the_table(spark, stocked, monkeypatch):
    before = sorted_rows(stocked.table(S.FACT))
    with monkeypatch.context() as patched:
        patched.setattr(storage, "merge_upsert", lambda *a, **k: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            stocked.merge_fact(_fact(spark, article(2, DAY, title="B")))
    assert sorted_rows(stocked.table(S.FACT)) == before


def test_vacuum_removes_replaced_files_only(spark, warehouse):
    warehouse.bootstrap()
    warehouse.merge_fact(_fact(spark, article(1, DAY), article(2, DAY)))
    warehouse.merge_fact(_fact(spark, article(1, DAY, title="new"), article(2, DAY, title="new")))
    warehouse.refresh_authors(NOW)
    warehouse.refresh_authors(NOW)
    before = sorted_rows(warehouse.table(S.FACT)), sorted_rows(warehouse.table(S.AUTHORS))
    assert warehouse.vacuum(timedelta(days=1)) == []
    removed = warehouse.vacuum(timedelta(0))
    assert sum(f"/{S.FACT}/" in folder for folder in removed) == 1
    assert sum(f"/{S.AUTHORS}/" in folder for folder in removed) == 1
    assert (sorted_rows(warehouse.table(S.FACT)), sorted_rows(warehouse.table(S.AUTHORS))) == before
    assert warehouse.vacuum(timedelta(0)) == []


@pytest.mark.parametrize("call", [3, 4, 6])
def test_vacuum_after_a_crash_loses_nothing(spark, tmp_path, monkeypatch, call):
    warehouse = new_warehouse(spark, tmp_path)
    warehouse.bootstrap()
    warehouse.merge_fact(_fact(spark, *[article(i, DAY + timedelta(days=400 * (i // 2 - 1))) for i in range(1, 6)]))
    batch = _fact(spark, *[move() for move in MOVES]).cache()
    before = warehouse.table(S.FACT).cache()
    expected = sorted_rows(op.merge_upsert(before, batch))
    with monkeypatch.context() as patched:
        _crash_at(patched, call)
        with pytest.raises(Crash):
            warehouse.merge_fact(batch)
    warehouse.vacuum(timedelta(0))
    warehouse.finish_publication()
    assert sorted_rows(warehouse.table(S.FACT)) == expected


def test_vacuum_does_not_read_the_fact(spark, stocked, monkeypatch):
    monkeypatch.setattr(plans.Warehouse, "table", lambda *_: 1 / 0)
    monkeypatch.setattr(type(spark), "table", lambda *_: 1 / 0)
    assert stocked.vacuum(timedelta(0)) == []


def test_one_repeated_key_rewrites_one_partition(spark, stocked, monkeypatch):
    written, real = [], plans.Warehouse._write_fact

    def write(self, placed, location):
        real(self, placed, location)
        written.append(len({tuple(row) for row in placed.select(*storage.PARTITION).distinct().collect()}))

    monkeypatch.setattr(plans.Warehouse, "_write_fact", write)
    rows = [article(i, DAY + timedelta(days=40 * i)) for i in range(10, 30)]
    newer = article(12, DAY + timedelta(days=480), title="newer", updated=DAY + timedelta(days=999))
    assert stocked.merge_fact(_fact(spark, *rows, newer), on_duplicate="latest") == 20
    assert written[0] > 10 and written[1] == 1
    assert stocked.article("12").first().title == "newer" and stocked.table(S.FACT).count() == 24


def test_the_calendar_grows_with_the_fact(spark, stocked):
    stocked.merge_fact(_fact(spark, article(50, DAY, published=datetime(2033, 5, 1))))
    fact, dates = stocked.table(S.FACT), stocked.table(S.DATES)
    assert dates.agg(F.max("date_key")).first()[0] == 20330501 and dates.count() == dates.distinct().count()
    assert plans.facts_without_day(fact, dates).isEmpty()
    assert plans.facts_without_day(fact, op.date_dimension(spark)).collect()[0]["date_key"] == 20330501
    assert plans.articles_per_quarter(fact, dates).agg(F.sum("articles")).first()[0] == 5


def test_few_missing_rows_do_not_shuffle_the_fact(spark, stocked):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = stocked.table(S.FACT)
        ids = spark.createDataFrame([("1",), ("2",), ("4",)], "article_id string")
        plan = op.reconcile_deletes(fact, ids, NOW, missing_rows=1)._jdf.queryExecution().executedPlan().toString()
        latest = op.keep_latest(fact, repeated=(op.duplicate_keys(fact), 0))
        latest_plan = latest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in plan and exchanges and "BroadcastHashJoin" in latest_plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "content" not in line]
    assert scans


def test_reads_by_time_and_key_skip_partitions(spark, stocked):
    rows = stocked.fact(DAY, DAY + timedelta(days=31))
    assert sorted_rows(rows, "article_id") == [("2",), ("3",)]
    assert len(rows.inputFiles()) < len(stocked.fact().inputFiles())
    assert sorted_rows(stocked.article("4"), "article_id") == [("4",)]
    assert stocked.article("99").count() == 0
    assert len(stocked.article("4").inputFiles()) == 1 and stocked.article("99").inputFiles() == []


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    warehouse.bootstrap()
    warehouse.file_bytes = 20_000
    text = F.repeat(F.sha2(F.col("id").cast("string"), 256), 4)
    rows = spark.range(4000).select(
        "id", F.lit("t").alias("title"), text.alias("content"), F.lit(DAY).cast("timestamp_ntz").alias("created_at"),
        F.lit(1).alias("author_id"), *[F.lit(None).cast("timestamp_ntz").alias(n) for n in ("published_at", "updated_at", "deleted_at")],
    )
    warehouse.merge_fact(op.transform_articles(rows))
    assert warehouse.partitions() == {(2020, 0)}
    assert len(warehouse.table(S.FACT).inputFiles()) > 3


def test_a_delete_sync_rewrites_partitions_without_a_shuffle(spark, stocked, monkeypatch):
    rewritten = []
    writer = type(spark.range(1).write)
    write = writer.parquet

    def noted(self, path, *args, **options):
        if "content" in self._df.columns:
            rewritten.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *args, **options)

    monkeypatch.setattr(writer, "parquet", noted)
    ids = spark.createDataFrame([("1",), ("2",), ("4",)], "article_id string")
    assert stocked.mark_missing(ids, NOW) == 1
    monkeypatch.undo()
    assert len(rewritten) == 1 and "Rebalance" not in rewritten[0] and "Repartition" not in rewritten[0]
    assert sorted_rows(stocked.table(S.FACT).where("is_deleted"), "article_id", "deleted_at") == [("3", NOW)]
    # Keys beyond a broadcast deal the rows by key, so those are dealt by partition again.
    monkeypatch.setattr(storage, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(merge, "BROADCAST_KEYS", 0)
    assert stocked.mark_missing(ids.where("article_id <> '4'"), NOW) == 1
    assert sorted_rows(stocked.table(S.FACT).where("is_deleted"), "article_id") == [("3",), ("4",)]
    assert len(stocked.table(S.FACT).inputFiles()) == len(stocked.partitions())


def test_a_writing_task_sorts_little_enough_to_do_without_spilling(warehouse):
    # Rows are estimated to take three times their shuffled size; four tasks share 60 % of an executor of 4 GB.
    assert 3 * warehouse.file_bytes <= 0.6 * (4 << 30) / 4
