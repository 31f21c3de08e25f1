import random
from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import article, clone, frame, new_warehouse, sorted_rows
from pyspark.sql import functions as F

from article_warehouse import operators as op, plans, schemas as S
from article_warehouse.operators import keys
from article_warehouse.plans import warehouse as storage
from article_warehouse.sources import FrameSource
from article_warehouse.sources.jdbc import span_predicates

DAY = datetime(2020, 1, 1)
NOW = datetime(2026, 1, 1)
ODD_KEYS = ["007", "x", "", "1.0", "-5", "0", "-32768", "-32767", str(1 << 62), "9" * 30, "ü", "1 "]


def key_frame(spark, listed):
    return spark.createDataFrame([(str(key),) for key in listed], "article_id string")


def _fact(spark, *rows):
    return op.transform_articles(frame(spark, list(rows)))


def test_bitmaps_find_the_keys_they_were_made_of(spark):
    rng = random.Random(1)
    ids = rng.sample(range(1, 200_000), 3000)
    rows = [(str(i), i % 7, i % 2 == 0) for i in ids] + [(key, 9, True) for key in ODD_KEYS]
    held = spark.createDataFrame(rows, "article_id string, part int, is_deleted boolean")
    bitmaps = op.key_bitmaps(held, "part")
    wanted = [*rng.sample(ids, 200), *rng.sample(range(1, 400_000), 500), *ODD_KEYS]
    wanted = list(dict.fromkeys(map(str, wanted)))
    found = op.located(bitmaps, key_frame(spark, wanted), len(wanted), "part")
    parts = {key: part for key, part, _ in rows}
    assert sorted_rows(found, "article_id", "part") == sorted(((key, parts[key]) for key in wanted if key in parts), key=repr)
    assert op.located(bitmaps, key_frame(spark, []), 0, "part").collect() == []
    # Only active keys are in the digests.
    assert bitmaps.agg(F.sum("keys")).first()[0] == sum(not deleted for _, _, deleted in rows)


def test_digests_tell_sets_apart(spark):
    ids = [*range(1, 70_000, 7), *ODD_KEYS]
    mine = op.key_digests(key_frame(spark, ids).repartition(5))
    assert op.differing_ranges(mine, op.key_digests(key_frame(spark, ids[::-1]))).collect() == []
    # Two ids that differ, with equal sums, and one more in a range that the first side has nothing in.
    other = [i for i in ids if i not in (1, 22, "x")] + [2, 21, 500_000]
    found = op.differing_ranges(mine, op.key_digests(key_frame(spark, other)))
    ranges = {row.key_range for row in key_frame(spark, [1, "x"]).select(keys.key_range(F.col("article_id")).alias("key_range")).collect()}
    assert {row.key_range for row in found.collect()} == ranges
    parts = op.key_digests(key_frame(spark, ids[::2])).unionByName(op.key_digests(key_frame(spark, ids[1::2])))
    added = parts.groupBy("key_range").agg(*[F.sum(name).alias(name) for name in ("keys", "digest_a", "digest_b")])
    assert sorted_rows(added) == sorted_rows(mine)


def test_the_database_computes_the_same_digests(spark):
    ids = [*range(-70_000, 70_000, 13), 0, 1, 32768, 32769, 1 << 40, (1 << 55) + 7]
    connection = duckdb.connect()
    connection.sql("create table articles (id bigint, deleted_at timestamp)")
    connection.executemany("insert into articles values (?, null)", [[i] for i in ids[:3000]])
    connection.sql("insert into articles select unnest(?::bigint[]), null", params=[ids[3000:]])
    connection.sql("insert into articles values (3, timestamp '2020-01-01')")
    sql = keys.digest_query("articles")
    found = connection.sql(f"select key_range, keys, digest_a, digest_b from ({sql})").fetchall()
    expected = op.key_digests(key_frame(spark, ids))
    assert sorted(found) == sorted(tuple(row) for row in expected.select("key_range", "keys", "digest_a", "digest_b").collect())


def test_reads_of_ranges_cover_them():
    spans = keys.id_spans([5, 3, 4, 9, -1])
    assert spans == [(-32767, 1), (3 * 32768 + 1, 6 * 32768 + 1), (9 * 32768 + 1, 10 * 32768 + 1)]
    for most in (10_000, 40_000, 1 << 20):
        connection = duckdb.connect()
        connection.sql("create table articles as select range as id from range(-100000, 400000)")
        reads = [connection.sql(f"select id from articles where {p}").fetchall() for p in span_predicates(spans, most)]
        assert all(len(read) <= most for read in reads)
        assert sorted(i for read in reads for (i,) in read) == [i for first, end in spans for i in range(first, end)]
    assert span_predicates([], 10) == ["1 = 0"]


@pytest.fixture(scope="module")
def years(spark, tmp_path_factory):
    """Twelve articles in each of ten years, in two slices."""
    warehouse = new_warehouse(spark, tmp_path_factory.mktemp("years"), plans.Layout("year", 2))
    warehouse.bootstrap()
    rows = [article(i, datetime(2010 + i // 12, 1 + i % 12, 1), author=100 + i % 5 if i % 9 else None) for i in range(120)]
    warehouse.merge_fact(_fact(spark, *rows))
    warehouse.refresh_authors(NOW)
    return warehouse


@pytest.fixture
def stocked(years, tmp_path):
    return clone(years, tmp_path)


def folders(warehouse, table=S.FACT):
    listed = {}
    for period, part in warehouse.partitions(table):
        spec = f"partition (created_period = {period}, key_slice = {part})"
        described = warehouse.spark.sql(f"describe table extended {warehouse.name(table)} {spec}")
        listed[period, part] = described.where("col_name = 'Location'").first()["data_type"]
    return listed


def check_companions(warehouse):
    """The tables beside the fact hold what their parts would be if made anew, and the dimension is that of the fact."""
    stored = warehouse.spark.table(warehouse.name(S.FACT))
    for companion in warehouse.companions:
        beside = warehouse.spark.table(warehouse.name(companion.table))
        assert sorted_rows(companion.make(stored, *storage.PARTITION)) == sorted_rows(beside), companion.table
        assert warehouse.partitions(companion.table) == warehouse.partitions(), companion.table
    found, wanted = op.authors_of_rollup(warehouse.table(S.ROLLUP), NOW), op.author_dimension(warehouse.table(S.FACT), NOW)
    assert sorted_rows(found) == sorted_rows(wanted)


def test_a_merge_reads_partitions_that_have_its_keys_only(spark, stocked, monkeypatch):
    asked, real = [], storage._within

    def within(partitions):
        asked.append(set(partitions))
        return real(partitions)

    keys_ = key_frame(spark, [5, 17, 500])
    candidates = {(row.created_period, row.key_slice) for row in stocked.locate(keys_, 3).collect()}
    assert {period for period, _ in candidates} == {2010, 2011}
    held = spark.table(stocked.name(S.FACT)).where(storage._within(candidates))
    assert len(held.inputFiles()) == len(candidates) == 2 and len(stocked.fact().inputFiles()) > 15
    monkeypatch.setattr(storage, "_within", within)
    before = folders(stocked)
    # 5 changes, 17 moves from 2011 to 2018, 500 is new.
    stocked.merge_fact(_fact(spark, article(5, datetime(2010, 6, 1), title="x"), article(17, datetime(2018, 1, 2)), article(500, datetime(2019, 1, 1))))
    assert all({period for period, _ in partitions} <= {2010, 2011, 2018, 2019} for partitions in asked)
    after = folders(stocked)
    assert {period for period, part in before if before[period, part] != after.get((period, part))} == {2010, 2011, 2018, 2019}
    rows = stocked.table(S.FACT).where("article_id in ('5', '17', '500')")
    assert sorted_rows(rows, "article_id", "title", F.year("created_at")) == [("17", "Title", 2018), ("5", "x", 2010), ("500", "Title", 2019)]
    assert stocked.table(S.FACT).count() == 121
    check_companions(stocked)


def test_a_repeated_window_publishes_nothing(spark, stocked):
    before, tables = folders(stocked), {name: folders(stocked, name) for name in (S.KEYS, S.ROLLUP)}
    batch = stocked.table(S.FACT).where("created_at < '2013-01-01'").cache()
    with stocked.staged(batch) as staged:
        stocked.merge_staged(staged)
    assert (staged.row_count, staged.unchanged, staged.published) == (36, 36, set())
    assert folders(stocked) == before and {name: folders(stocked, name) for name in tables} == tables
    assert stocked._properties(S.FACT).get(storage._AUTHORS_BEHIND) == ""
    # One row of the window changed: its partition alone is written.
    changed = batch.withColumn("content", F.when(F.col("article_id") == "20", "new").otherwise(F.col("content")))
    assert stocked.merge_fact(changed) == 36
    assert [key for key, folder in folders(stocked).items() if folder != before[key]] == [key for key in before if key[0] == 2011 and key in _partition_of(stocked, 20)]
    assert sorted_rows(stocked.table(S.FACT).where("content = 'new'"), "article_id") == [("20",)]
    check_companions(stocked)


def _partition_of(warehouse, key):
    return {(row.created_period, row.key_slice) for row in warehouse.locate(key_frame(warehouse.spark, [key]), 1).collect()}


def test_equal_values_in_other_columns_are_a_change(spark, stocked):
    t = datetime(2010, 6, 1)
    stocked.merge_fact(_fact(spark, article(5, t, title="a", content=None)))
    stocked.merge_fact(_fact(spark, article(5, t, title=None, content="a")))
    assert sorted_rows(stocked.table(S.FACT).where("article_id = '5'"), "title", "content") == [("", "a")]
    swapped = stocked.table(S.FACT).where("article_id = '5'")
    for published, deleted in ((t, None), (None, t)):
        values = {"published_at": published, "deleted_at": deleted}
        stocked.merge_fact(swapped.withColumns({name: F.lit(value).cast("timestamp_ntz") for name, value in values.items()}))
        found = stocked.table(S.FACT).where("article_id = '5'").select("published_at", "deleted_at").first()
        assert tuple(found) == (published, deleted)


def test_the_tables_beside_the_fact_follow_it(spark, stocked):
    check_companions(stocked)
    rows = [article(i, datetime(2009 + i // 20, 1, 1), author=7) for i in range(30, 50)] + [article(400, None, updated=DAY)]
    stocked.merge_fact(_fact(spark, *rows))
    check_companions(stocked)
    assert stocked.mark_missing(key_frame(spark, range(3, 120)), NOW) == 4
    check_companions(stocked)
    # Of the author dimension's scan nothing is left of the fact.
    read = op.authors_of_rollup(stocked.table(S.ROLLUP), NOW).inputFiles()
    assert read and all(f"_{S.ROLLUP}/" in file for file in read)
    stocked.vacuum(timedelta(0))
    check_companions(stocked)


def test_a_warehouse_without_them_gets_them(spark, stocked):
    for table in (S.KEYS, S.ROLLUP, S.OUTLIERS):
        spark.sql(f"drop table {stocked.name(table)}")
    stocked.merge_fact(_fact(spark, article(5, datetime(2015, 6, 1), title="x")))
    check_companions(stocked)
    stocked.vacuum(timedelta(0))
    check_companions(stocked)
    assert stocked.article("5").first().title == "x"


@pytest.mark.parametrize("call", [2, 3, 5, 9])
def test_a_crash_leaves_the_tables_in_step(spark, stocked, monkeypatch, call):
    batch = _fact(spark, article(5, datetime(2015, 6, 1), title="x"), article(40, datetime(2030, 1, 1))).cache()
    expected = sorted_rows(op.merge_upsert(stocked.table(S.FACT).cache(), batch))
    real, seen = plans.Warehouse._alter, []

    def alter(self, table, change):
        seen.append(change)
        if len(seen) == call:
            raise RuntimeError("crash")
        real(self, table, change)

    with monkeypatch.context() as patched:
        patched.setattr(plans.Warehouse, "_alter", alter)
        with pytest.raises(RuntimeError):
            stocked.merge_fact(batch)
    stocked.vacuum(timedelta(0))
    stocked.make_ready()
    assert sorted_rows(stocked.table(S.FACT)) == expected
    check_companions(stocked)


def test_deletes_ask_for_ids_of_differing_ranges_only(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path, plans.Layout("year", 2))
    rows = [article(i * 1000, datetime(2010 + i // 20, 1, 1), deleted=DAY if i % 10 == 3 else None) for i in range(1, 201)]
    warehouse.bootstrap()
    warehouse.merge_fact(_fact(spark, *rows))
    asked = []

    class Source(FrameSource):
        def ids_within(self, spans):
            asked.append(spans)
            inside = " or ".join(f"(id >= {first} and id < {end})" for first, end in spans)
            return op.source_ids(self.articles.where(inside))

    def sync(listed, **more):
        source = Source(frame(spark, listed))
        wanted = sorted_rows(op.reconcile_deletes(warehouse.table(S.FACT).cache(), source.ids(), NOW))
        marked = warehouse.mark_missing(source.ids(), NOW, digests=source.id_digests(), ids_within=source.ids_within, **more)
        assert sorted_rows(warehouse.table(S.FACT)) == wanted
        check_companions(warehouse)
        return marked

    # Deleted rows that the source still has are no difference.
    assert sync(rows) == 0 and asked == []
    # 70,000 is gone, 50,500 new and not loaded yet; both are in one range of ids each.
    left = [row for row in rows if row[0] != 70_000] + [article(50_500, DAY)]
    assert sync(left) == 1
    assert asked == [[(32769, 3 * 32768 + 1)]]
    assert sync(left) == 0
    # A row that is gone although it was deleted changes nothing; one with another time moved.
    assert sync([row for row in left if row[0] != 13_000]) == 0
    moved = article(40_000, datetime(2025, 1, 1))
    warehouse.merge_fact(_fact(spark, moved))
    assert sync([moved if row[0] == 40_000 else row for row in left]) == 0
    with pytest.raises(plans.DeleteGuardError, match="of 179 active"):
        sync([], max_delete_fraction=0.9)
    assert sync([]) == 179


def test_implausible_days_are_listed_and_counted(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    warehouse.bootstrap()
    days = warehouse.table(S.DATES).count()
    far, early = datetime(9999, 12, 30), datetime(1, 3, 1)
    rows = [article(1, DAY), article(2, DAY, published=far), article(3, early, published=DAY), article(4, far)]
    warehouse.merge_fact(_fact(spark, *rows))
    assert warehouse.table(S.DATES).count() == days
    assert sorted_rows(warehouse.table(S.OUTLIERS), "article_id") == [("2",), ("3",), ("4",)]
    assert sorted_rows(plans.outlier_days(warehouse.table(S.OUTLIERS)), "date_column", "date_key", "row_count") == [
        ("created_date_key", 10301, 1), ("created_date_key", 99991230, 1), ("published_date_key", 99991230, 2),
    ]
    dates, rollup = warehouse.table(S.DATES), warehouse.table(S.ROLLUP)
    for found in (plans.articles_per_quarter(warehouse.table(S.FACT), dates), plans.quarters_of_rollup(rollup, dates)):
        assert sorted_rows(found, "year", "quarter", "articles") == [(2020, 1, 2), (None, None, 2)]
    for found in (plans.weekend_share_per_author(warehouse.table(S.FACT), dates), plans.weekends_of_rollup(rollup, dates)):
        assert sorted_rows(found, "author_id", "articles", "weekend_articles") == [(101, 4, 0)]
    # Corrected articles leave the list, and a later day within the years widens the calendar.
    warehouse.merge_fact(_fact(spark, article(2, DAY, published=datetime(2035, 1, 1)), article(3, DAY), article(4, DAY)))
    assert warehouse.table(S.OUTLIERS).count() == 0 and warehouse.table(S.DATES).count() > days
    check_companions(warehouse)


def test_a_lookup_skips_row_groups(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    warehouse.bootstrap()
    warehouse.merge_fact(_fact(spark, *[article(i * 2, DAY, author=i % 3) for i in range(1, 3000)]))

    def scanned(key):
        rows = spark.table(warehouse.name(S.FACT)).where(F.col("article_id") == key)
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().head()
        return plan.metrics().apply("numOutputRows").value()

    assert scanned("4000") > 0 and scanned("4001") == 0
    # A small table stays small.
    assert all(size < 400_000 for size in [storage.stored_bytes(spark, file) for file in warehouse.fact().inputFiles()])
