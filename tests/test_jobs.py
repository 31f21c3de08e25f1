import json
from datetime import datetime, timedelta

import pytest
from conftest import AS_OF, article, clone, frame, local, new_warehouse, seed_rows, sorted_rows

from article_warehouse import operators as op, plans, schemas as S
from article_warehouse.operators import DuplicateKeyError, author_dimension, date_dimension
from article_warehouse.plans.control import details_text
from article_warehouse.sources import FrameSource

HOUR = timedelta(hours=1)


def source(spark, rows):
    return FrameSource(frame(spark, rows).cache())


def hourly(spark, warehouse, rows, at):
    return plans.run_hourly(source(spark, rows), warehouse, at - HOUR, at, at)


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    warehouse = new_warehouse(spark, tmp_path_factory.mktemp("seed"))
    assert hourly(spark, warehouse, seed_rows(), AS_OF) == {"backfilled": 8, "changed": None, "marked_deleted": 0}
    return warehouse


@pytest.fixture
def seeded(first_run, tmp_path):
    """A warehouse after its first hourly run over the seed cases."""
    return clone(first_run, tmp_path)


def revised(rows, id, **changes):
    names = S.ARTICLES_SCHEMA.names
    return [tuple({**dict(zip(names, row)), **changes}.values()) if row[0] == id else row for row in rows]


def test_seed_run_matches_the_published_counts(spark, seeded):
    fact, authors = seeded.table(S.FACT), seeded.table(S.AUTHORS)
    counts = plans.audit_counts(frame(spark, seed_rows()), fact, seeded.table(S.DATES), authors)
    assert {row["check_name"]: row["row_count"] for row in counts.collect()} == {
        "source_rows": 8,
        "fact_rows": 8,
        "deleted_rows": 1,
        "date_rows": 5844,
        "author_rows": 4,
    }
    assert sorted_rows(authors, "author_id", "author_name", "total_article_count", "active_article_count") == [
        (101, "author_101", 3, 3),
        (102, "author_102", 2, 2),
        (103, "author_103", 2, 2),
        (104, "author_104", 1, 0),
    ]
    # Created at midnight UTC; the business date is the same day.
    third = fact.where("article_id = '3'").first()
    assert (third.created_at, third.created_date_key) == (datetime(2016, 11, 6), 20161106)
    # 21:00 UTC the day before is the next day, 04:00 local.
    assert fact.where("article_id = '7'").first().created_date_key == 20260522


def test_seed_run_leaves_two_control_records(spark, seeded):
    rows = {row["process_name"]: row for row in plans.control_records(seeded.table(S.CONTROL)).collect()}
    assert set(rows) == {S.BACKFILL_PROCESS, S.INCREMENTAL_PROCESS}
    assert all(row["state"] == "completed" and row["watermark"] == AS_OF for row in rows.values())
    assert rows[S.BACKFILL_PROCESS]["details"] == (
        '{"rows_loaded": 8, "batches_loaded": 6, '
        '"source_start": "2016-01-01 00:00:00+00:00", "source_end": "2026-05-22 03:00:00+00:00"}'
    )
    assert json.loads(rows[S.INCREMENTAL_PROCESS]["details"]) == {"source": "historical_backfill_completion"}


def test_an_update_reaches_the_fact(spark, seeded):
    changed = revised(seed_rows(), 1, title="Updated title", updated_at=AS_OF + HOUR / 2)
    assert hourly(spark, seeded, changed, AS_OF + HOUR) == {"backfilled": 0, "changed": 1, "marked_deleted": 0}
    assert seeded.article("1").first().title == "Updated title"
    assert seeded.table(S.FACT).count() == 8
    assert plans.control_mark(seeded, S.INCREMENTAL_PROCESS) == AS_OF + HOUR
    author = seeded.table(S.AUTHORS).where("author_id = 101").first()
    assert author.last_article_updated_at == AS_OF + HOUR / 2 and author.updated_at == AS_OF + HOUR


def test_a_hard_delete_is_marked_and_the_row_kept(spark, seeded):
    remaining = [row for row in seed_rows() if row[0] != 2]
    at = AS_OF + HOUR
    assert hourly(spark, seeded, remaining, at) == {"backfilled": 0, "changed": 0, "marked_deleted": 1}
    assert sorted_rows(plans.article_state(seeded.table(S.FACT), "2")) == [("2", at, True)]
    assert seeded.article("2").first().updated_at == at
    author = seeded.table(S.AUTHORS).where("author_id = 102").first()
    assert (author.total_article_count, author.active_article_count) == (2, 1)
    # The next run finds nothing new, and a restored source row comes back.
    assert hourly(spark, seeded, remaining, at + HOUR)["marked_deleted"] == 0
    restored = revised(seed_rows(), 2, updated_at=at + HOUR)
    assert hourly(spark, seeded, restored, at + 2 * HOUR) == {"backfilled": 0, "changed": 1, "marked_deleted": 0}
    assert seeded.article("2").first().is_deleted is False


def test_an_empty_window_moves_the_mark_only(spark, seeded):
    authors = sorted_rows(seeded.table(S.AUTHORS))
    end = AS_OF + 3 * HOUR
    assert plans.run_incremental(source(spark, seed_rows()), seeded, AS_OF, end, end) == 0
    record = plans.control_record(seeded, S.INCREMENTAL_PROCESS)
    assert record["watermark"] == end and json.loads(record["details"])["rows_loaded"] == 0
    assert sorted_rows(seeded.table(S.AUTHORS)) == authors


def test_a_mark_at_the_end_skips_the_window(spark, seeded):
    before = plans.control_record(seeded, S.INCREMENTAL_PROCESS)
    assert plans.run_incremental(source(spark, seed_rows()), seeded, AS_OF - HOUR, AS_OF) is None
    assert plans.control_record(seeded, S.INCREMENTAL_PROCESS) == before


def test_the_window_starts_at_the_mark_not_at_the_interval(spark, seeded):
    # A delayed run covers everything since the mark.
    changed = revised(seed_rows(), 4, title="late", updated_at=AS_OF + HOUR)
    end = AS_OF + 10 * HOUR
    assert plans.run_incremental(source(spark, changed), seeded, end - HOUR, end, end) == 1
    # The window is half open: a change at its end belongs to the next.
    changed = revised(changed, 5, title="edge", updated_at=end)
    assert plans.run_incremental(source(spark, changed), seeded, end, end + HOUR, end) == 1
    assert seeded.article("5").first().title == "edge"


def test_without_mark_the_interval_decides(spark, warehouse):
    rows = [article(i, AS_OF, updated=AS_OF + i * HOUR) for i in range(5)]
    assert plans.run_incremental(source(spark, rows), warehouse, AS_OF + HOUR, AS_OF + 3 * HOUR) == 2
    assert sorted_rows(warehouse.table(S.FACT), "article_id") == [("1",), ("2",)]


def test_lookback_reads_late_commits_again(spark, seeded):
    late = seed_rows() + [article(9, AS_OF - HOUR, updated=AS_OF - HOUR / 2)]
    end = AS_OF + HOUR
    assert plans.run_incremental(source(spark, late), seeded, AS_OF, end, end) == 0
    assert plans.run_incremental(source(spark, late), seeded, end, end + HOUR, end, lookback=3 * HOUR) == 1
    assert seeded.article("9").count() == 1


def test_a_completed_backfill_loads_nothing(spark, seeded):
    more = seed_rows() + [article(9, local("2018-01-01 00:00"))]
    assert plans.run_backfill(source(spark, more), seeded, AS_OF + HOUR) == 0
    assert seeded.table(S.FACT).count() == 8
    assert plans.control_mark(seeded, S.INCREMENTAL_PROCESS) == AS_OF


def test_a_completed_backfill_restores_a_missing_mark(spark, seeded):
    seeded.replace_table(S.CONTROL, seeded.table(S.CONTROL).where(f"process_name = '{S.BACKFILL_PROCESS}'"))
    assert plans.run_backfill(source(spark, seed_rows()), seeded, AS_OF + HOUR) == 0
    record = plans.control_record(seeded, S.INCREMENTAL_PROCESS)
    assert record["watermark"] == AS_OF and record["last_success_at"] == AS_OF + HOUR
    assert json.loads(record["details"]) == {"source": "historical_backfill_existing_state"}


def test_backfill_takes_history_from_its_start_only(spark, warehouse):
    rows = [
        article(1, datetime(2015, 12, 31, 23)),
        article(2, datetime(2016, 1, 1)),
        article(3, None, updated=AS_OF),
        article(4, AS_OF),
    ]
    assert plans.run_backfill(source(spark, rows), warehouse, AS_OF) == 1
    assert sorted_rows(warehouse.table(S.FACT), "article_id") == [("2",)]
    # The others arrive when they change later.
    assert plans.run_incremental(source(spark, rows), warehouse, AS_OF, AS_OF + HOUR, AS_OF) == 2
    assert sorted_rows(warehouse.table(S.FACT), "article_id") == [("2",), ("3",), ("4",)]


def test_backfill_of_nothing(spark, warehouse):
    assert plans.run_backfill(source(spark, []), warehouse, AS_OF) == 0
    assert plans.control_record(warehouse, S.BACKFILL_PROCESS)["state"] == "completed"
    assert warehouse.table(S.AUTHORS).count() == 0


def test_a_failed_backfill_starts_again(spark, warehouse, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(plans.Warehouse, "refresh_authors", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            plans.run_backfill(source(spark, seed_rows()), warehouse, AS_OF)
    record = plans.control_record(warehouse, S.BACKFILL_PROCESS)
    # The time of the last success is set while running as well.
    assert (record["state"], record["last_success_at"]) == ("running", AS_OF)
    assert json.loads(record["details"]) == {"chunk_days": 31, "batch_size": 5000}
    assert plans.control_mark(warehouse, S.INCREMENTAL_PROCESS) is None
    assert plans.run_backfill(source(spark, seed_rows()), warehouse, AS_OF + HOUR) == 8
    assert warehouse.table(S.FACT).count() == 8


def test_a_failed_backfill_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    rows = [article(i, datetime(2016, 1, 1) + timedelta(days=40 * i), author=i % 4) for i in range(60)]
    whole, broken = new_warehouse(spark, tmp_path), new_warehouse(spark, tmp_path)
    plans.run_backfill(source(spark, rows), whole, AS_OF, batch_size=2)
    read, real = [], plans.Warehouse.merge_staged

    class Source(type(source(spark, rows))):
        def created(self, start, end, days):
            read.append((start, end))
            return super().created(start, end, days)

    def merge(self, staged, properties):
        if len(read) == 3:
            raise RuntimeError("lost")
        real(self, staged, properties)

    articles = Source(frame(spark, rows))
    with monkeypatch.context() as patched:
        patched.setattr(plans.Warehouse, "merge_staged", merge)
        with pytest.raises(RuntimeError, match="lost"):
            plans.run_backfill(articles, broken, AS_OF, batch_size=2, group_rows=20)
    assert broken.table(S.FACT).count() == 40 and [start for start, _ in read[1:]] == [end for _, end in read[:-1]]
    # Other terms start anew, the same go on; the mark stays that of the first run.
    terms = broken.note("backfill")["terms"]
    assert (terms["batch_size"], terms["chunk_days"]) == (2, 31)
    later = rows[5][:1] + ("changed later", *rows[5][2:6], AS_OF + HOUR / 2, None)
    again = Source(frame(spark, [later if row[0] == 5 else row for row in rows]))
    assert plans.run_backfill(again, broken, AS_OF + HOUR, batch_size=2, group_rows=20) == 60
    assert read[3:] == [(read[2][0], AS_OF)] and broken.note("backfill") is None
    assert sorted_rows(broken.table(S.FACT)) == sorted_rows(whole.table(S.FACT))
    for process in (S.BACKFILL_PROCESS, S.INCREMENTAL_PROCESS):
        ours, theirs = plans.control_record(broken, process), plans.control_record(whole, process)
        assert (ours["details"], ours["watermark"], ours["state"]) == (theirs["details"], theirs["watermark"], theirs["state"])
    # What changed meanwhile comes with the next load.
    assert plans.run_incremental(again, broken, AS_OF, AS_OF + HOUR, AS_OF + HOUR) == 1
    assert broken.article("5").first()["title"] == "changed later"


def test_groups_of_windows():
    day = datetime(2020, 1, 1)
    ends = [day + timedelta(days=10 * i) for i in range(6)]
    assert op.window_groups({}, day, ends[5], 10, 3) == [(day, ends[5])]
    assert op.window_groups({0: 2, 1: 1, 2: 1, 4: 9}, day, ends[5], 10, 3) == [(day, ends[2]), (ends[2], ends[4]), (ends[4], ends[5])]
    assert op.window_groups({3: 50}, day, ends[5], 10, 3) == [(day, ends[5])]
    assert op.window_groups({}, day, day, 10, 3) == []


def test_the_mark_stays_if_a_load_fails(spark, seeded, monkeypatch):
    changed = source(spark, revised(seed_rows(), 1, title="new", updated_at=AS_OF))
    with monkeypatch.context() as patched:
        patched.setattr(plans.Warehouse, "refresh_authors", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            plans.run_incremental(changed, seeded, AS_OF, AS_OF + HOUR)
    assert plans.control_mark(seeded, S.INCREMENTAL_PROCESS) == AS_OF
    assert plans.run_incremental(changed, seeded, AS_OF, AS_OF + HOUR, AS_OF + HOUR) == 1
    assert seeded.table(S.FACT).count() == 8


def test_a_failure_stops_the_hourly_run(spark, warehouse, monkeypatch):
    done = []
    monkeypatch.setattr(plans.jobs, "run_backfill", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    monkeypatch.setattr(plans.jobs, "run_incremental", lambda *_: done.append("incremental"))
    with pytest.raises(RuntimeError):
        hourly(spark, warehouse, seed_rows(), AS_OF)
    assert done == []


def test_the_hourly_run_refreshes_authors_once(spark, warehouse, monkeypatch):
    refreshed, real = [], plans.Warehouse.refresh_authors
    monkeypatch.setattr(plans.Warehouse, "refresh_authors", lambda self, at: (refreshed.append(at), real(self, at)))
    hourly(spark, warehouse, seed_rows(), AS_OF)
    assert refreshed == [AS_OF]
    rows = revised(seed_rows(), 1, title="new", updated_at=AS_OF + HOUR / 2)[:-2]
    at = AS_OF + HOUR
    found = plans.run_hourly(source(spark, rows), warehouse, AS_OF, at, at)
    assert found == {"backfilled": 0, "changed": 1, "marked_deleted": 1} and refreshed == [AS_OF, at]
    assert plans.run_hourly(source(spark, rows), warehouse, at, at + HOUR, at + HOUR)["marked_deleted"] == 0
    assert refreshed == [AS_OF, at]
    expected = author_dimension(warehouse.table(S.FACT), at)
    assert sorted_rows(warehouse.table(S.AUTHORS)) == sorted_rows(expected.select(warehouse.table(S.AUTHORS).columns))


def test_authors_catch_up_after_a_failed_sync(spark, seeded, monkeypatch):
    gone = source(spark, seed_rows()[1:])
    with monkeypatch.context() as patched:
        patched.setattr(plans.Warehouse, "refresh_authors", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            plans.run_delete_sync(gone, seeded, AS_OF + HOUR)
    # The row is marked already, so the next sync changes none, and has the authors to catch up.
    assert plans.run_delete_sync(gone, seeded, AS_OF + 2 * HOUR) == 0
    authors = seeded.table(S.AUTHORS).where("author_id = 101").first()
    assert (authors["total_article_count"], authors["active_article_count"]) == (3, 2)


def test_repeated_source_rows(spark, warehouse):
    rows = seed_rows() + [article(1, local("2016-04-12 09:30"), title="later", updated=AS_OF - HOUR)]
    with pytest.raises(DuplicateKeyError):
        plans.run_backfill(source(spark, rows), warehouse, AS_OF)
    assert plans.run_backfill(source(spark, rows), warehouse, AS_OF, on_duplicate="latest") == 8
    assert warehouse.article("1").first().title == "later"


def test_the_delete_guard_stops_the_sync(spark, seeded):
    with pytest.raises(plans.DeleteGuardError):
        plans.run_delete_sync(source(spark, []), seeded, AS_OF, max_delete_fraction=0.5)
    assert plans.run_delete_sync(source(spark, []), seeded, AS_OF) == 7


def test_jobs_do_not_depend_on_the_session_zone(spark, tmp_path, zone):
    warehouse = new_warehouse(spark, tmp_path)
    hourly(spark, warehouse, seed_rows(), AS_OF)
    keys = sorted_rows(warehouse.table(S.FACT), "article_id", "created_at", "created_date_key")
    assert keys[2] == ("3", datetime(2016, 11, 6), 20161106)
    assert keys[5] == ("6", AS_OF - 15 * HOUR, 20260521)
    assert plans.control_mark(warehouse, S.INCREMENTAL_PROCESS) == AS_OF
    assert '"source_end": "2026-05-22 03:00:00+00:00"' in plans.control_record(warehouse, S.BACKFILL_PROCESS)["details"]


def test_details_text():
    assert details_text(None) == "{}"
    assert details_text({"rows": 1, "at": local("2016-12-18 07:00"), "name": "x"}) == (
        '{"rows": 1, "at": "2016-12-18 00:00:00+00:00", "name": "x"}'
    )


def test_details_without_a_form_in_json_become_text():
    assert details_text({"day": AS_OF.date(), "span": HOUR}) == '{"day": "2026-05-22", "span": "1:00:00"}'


def test_the_hourly_run_takes_the_options_of_its_jobs(spark, warehouse):
    rows = seed_rows() + [article(1, local("2016-05-03 16:20"), title="later", updated=AS_OF - HOUR)]
    options = {"on_duplicate": "latest", "chunk_days": 400, "batch_size": 2, "start": datetime(2016, 6, 1)}
    found = plans.run_hourly(source(spark, rows), warehouse, AS_OF - HOUR, AS_OF, AS_OF, **options)
    assert found == {"backfilled": 7, "changed": None, "marked_deleted": 0}
    with pytest.raises(plans.DeleteGuardError):
        at = AS_OF + HOUR
        plans.run_hourly(source(spark, []), warehouse, AS_OF, at, at, max_delete_fraction=0.1, lookback=HOUR, zone="UTC")


def test_control_records_are_merged_by_process(spark, warehouse):
    warehouse.bootstrap()
    assert plans.control_record(warehouse, "a") is None and plans.control_mark(warehouse, "a") is None
    plans.upsert_control(warehouse, "a", "running", at=AS_OF)
    plans.upsert_control(warehouse, "b", "completed", AS_OF, {"n": 1}, AS_OF)
    plans.upsert_control(warehouse, "a", "completed", AS_OF + HOUR, at=AS_OF)
    assert sorted_rows(warehouse.table(S.CONTROL), *S.CONTROL_SCHEMA.names) == [
        ("a", "completed", AS_OF + HOUR, AS_OF, "{}"),
        ("b", "completed", AS_OF, AS_OF, '{"n": 1}'),
    ]


def test_star_queries_over_the_seed(spark, seeded):
    fact, dates, authors = (seeded.table(name) for name in (S.FACT, S.DATES, S.AUTHORS))
    rows = plans.articles_per_author_year(fact, dates, authors).collect()
    assert [(r.author_id, r.year, r.articles, r.active_articles) for r in rows] == [
        (101, 2016, 2, 2), (101, 2026, 1, 1), (102, 2016, 1, 1), (102, 2020, 1, 1),
        (103, 2020, 1, 1), (103, 2026, 1, 1), (104, 2026, 1, 0),
    ]
    weekend = {r.author_id: r.weekend_share for r in plans.weekend_share_per_author(fact, dates).collect()}
    # 2016-11-06 was a Sunday.
    assert weekend == {101: 1 / 3, 102: 0.0, 103: 0.0, 104: 0.0}
    assert plans.articles_per_quarter(fact, date_dimension(spark)).count() == 6
    active = plans.active_articles_per_author(fact, authors)
    assert sorted_rows(active, "author_id", "active_articles") == [(101, 3), (102, 2), (103, 2)]
