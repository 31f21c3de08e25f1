from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import article, frame

from article_warehouse import schemas as S
from article_warehouse.sources import FrameSource, JdbcSource, article_source
from article_warehouse.sources.jdbc import range_predicates, ranges

COUNTED = "range_index bigint, row_count bigint, lowest bigint, highest bigint"
START, END = datetime(2016, 1, 1), datetime(2016, 3, 1)


def test_a_source_needs_a_location(spark):
    for location in (None, ""):
        with pytest.raises(ValueError, match="no source location"):
            article_source(spark, location)


def test_a_file_source_has_the_eight_columns(spark, tmp_path):
    rows = frame(spark, [article(1, START)])
    rows.selectExpr("*", "'x' as other").write.parquet(f"{tmp_path}/articles")
    source = article_source(spark, f"{tmp_path}/articles")
    assert isinstance(source, FrameSource)
    assert source.rows().columns == S.ARTICLES_SCHEMA.names
    assert source.ids().dtypes == [("article_id", "string")]


def test_ranges_adjoin():
    assert ranges(START, END, timedelta(days=31)) == [
        (START, datetime(2016, 2, 1)),
        (datetime(2016, 2, 1), END),
    ]
    assert ranges(START, START, timedelta(days=31)) == []


def test_large_ranges_are_divided_by_id():
    cuts = ranges(START, END, timedelta(days=31))
    first = "created_at >= TIMESTAMPTZ '2016-01-01 00:00:00+00' AND created_at < TIMESTAMPTZ '2016-02-01 00:00:00+00'"
    second = "created_at >= TIMESTAMPTZ '2016-02-01 00:00:00+00' AND created_at < TIMESTAMPTZ '2016-03-01 00:00:00+00'"
    assert range_predicates("created_at", cuts, {1: (2500, 10, 39)}, 1000) == [
        first,
        f"{second} AND id < 20",
        f"{second} AND id >= 20 AND id < 30",
        f"{second} AND id >= 30",
    ]
    # Rows of one time are divided too, as far as they have different ids.
    assert range_predicates("created_at", cuts[:1], {0: (2500, 7, 8)}, 1000) == [f"{first} AND id < 8", f"{first} AND id >= 8"]
    assert range_predicates("created_at", [], {}, 1000) == ["1 = 0"]


class RecordedReads(JdbcSource):
    """Answers the small queries itself and records what would be read; no database is needed."""

    def __init__(self, spark, answers, **options):
        super().__init__(spark, "jdbc:postgresql://host/db", **options)
        self.answers, self.queries, self.reads = answers, [], []

    def _query(self, query):
        self.queries.append(query)
        return self.spark.createDataFrame(*self.answers)

    def _read(self, predicates):
        self.reads.append(predicates)
        return frame(self.spark, [])


def test_history_reads_follow_the_counts(spark):
    source = RecordedReads(spark, ([(0, 10, 1, 10), (1, 4_000, 11, 4_010)], COUNTED), max_rows=1000)
    source.created(START, END, 31)
    assert len(source.reads[0]) == 1 + 4
    assert source.queries == [
        "SELECT floor(extract(epoch FROM created_at - TIMESTAMPTZ '2016-01-01 00:00:00+00') / 2678400.0) AS range_index, "
        "count(*) AS row_count, min(id) AS lowest, max(id) AS highest FROM articles WHERE created_at >= TIMESTAMPTZ '2016-01-01 00:00:00+00' "
        "AND created_at < TIMESTAMPTZ '2016-03-01 00:00:00+00' GROUP BY 1"
    ]


def test_changes_are_read_in_slices(spark):
    source = RecordedReads(spark, ([], COUNTED), change_reads=4)
    source.changed(START, START + timedelta(hours=1))
    assert len(source.reads[0]) == 4
    assert source.reads[0][0].endswith("updated_at < TIMESTAMPTZ '2016-01-01 00:15:00+00'")
    source.changed(START, START)
    assert source.reads[1] == ["1 = 0"]


def test_ids_are_read_in_ranges(spark):
    source = RecordedReads(spark, ([(1, 2_500)], "lowest bigint, highest bigint"), max_rows=1000)
    assert source.id_read_options() == {"column": "id", "lowerBound": 1, "upperBound": 2501, "numPartitions": 3}
    source = RecordedReads(spark, ([(None, None)], "lowest bigint, highest bigint"))
    assert source.id_read_options() == {}


class InDuckDb(JdbcSource):
    """Runs the SQL of small queries and of reads in DuckDB, in place of a database server."""

    def __init__(self, spark, connection, **options):
        super().__init__(spark, "jdbc:postgresql://host/db", **options)
        self.connection, self.sizes = connection, []

    def _query(self, query):
        found = self.connection.sql(query)
        rows = [tuple(value if value is None else int(value) for value in row) for row in found.fetchall()]
        return self.spark.createDataFrame(rows, ", ".join(f"{name} bigint" for name in found.columns))

    def _read(self, predicates):
        reads = [self.connection.sql(f"select id, created_at from articles where {p}").fetchall() for p in predicates]
        self.sizes = [len(read) for read in reads]
        return sorted(id for read in reads for id, _ in read)


def test_reads_of_clustered_ids_are_equally_deep(spark):
    connection = duckdb.connect()
    connection.sql("set timezone = 'UTC'")
    # Three dense clusters far apart, one with a third of the rows at one time.
    connection.sql(
        "create table articles as select id, timestamptz '2016-01-01 00:00:00+00' + to_hours(cast(case when id % 3 = 0 then 5 else id % 1400 end as integer)) "
        "as created_at from (select unnest(range(1, 4000)) as id union all select unnest(range(1000000, 1003000)) "
        "union all select unnest(range(900000000, 900005000)))"
    )
    source = InDuckDb(spark, connection, max_rows=500)
    within = [id for (id,) in connection.sql("select id from articles where created_at < timestamptz '2016-03-01 00:00:00+00' order by 1").fetchall()]
    assert source.created(START, END, 31) == within
    assert max(source.sizes) <= 1000 and sum(source.sizes) == len(within)
    # The last read of each of both ranges may be short.
    assert len(source.sizes) <= len(within) / 500 + 2
    assert source.rows() == [id for (id,) in connection.sql("select id from articles order by 1").fetchall()]
    assert max(source.sizes) <= 1000 and min(source.sizes[:-1]) >= 250
    # Equal widths would put most rows into a few reads.
    counts = {0: (len(within), 1, 900004999)}
    wide = range_predicates("created_at", [(START, END)], counts, 500)
    assert max(connection.sql(f"select count(*) from articles where {p}").fetchall()[0][0] for p in wide) > 2000


def test_dense_tables_need_no_second_query(spark):
    connection = duckdb.connect()
    connection.sql("create table articles as select unnest(range(1, 4000)) as id")
    assert InDuckDb(spark, connection, max_rows=500).id_bounds() == []
    connection.sql("delete from articles")
    assert InDuckDb(spark, connection, max_rows=500).id_bounds() == []


def test_connection_properties(spark):
    source = article_source(spark, "jdbc:postgresql://host/db", properties={"user": "reader"}, fetch_size=7)
    assert isinstance(source, JdbcSource)
    assert source.properties == {"driver": "org.postgresql.Driver", "user": "reader", "fetchsize": "7"}
