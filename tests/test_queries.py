"""Every registered query against the same query in DuckDB."""

import pytest
from conftest import TESTDATA

import __spark_entry__ as registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


# Queries of a subpackage that may be left out have tests of their own.
NAMES = [name for name, query in QUERIES.items() if query.__module__ == registry.__name__]


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, TESTDATA)
    columns = sorted(found.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    rows = sorted(repr(tuple(row)) for row in found.select(*columns).collect())
    quoted = ", ".join(f'"{column}"' for column in columns)
    assert rows == sorted(repr(row) for row in duck.sql(f"select {quoted} from ({ORACLES[name]})").fetchall())


def test_results_do_not_depend_on_the_session_zone(spark, duck, zone):
    for name in ("fact_articles", "history_windows", "star_author_year"):
        test_query_equals_oracle(spark, duck, name)


def test_flagship_query(spark):
    rows = registry.entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: (r.author_id, r.year))
