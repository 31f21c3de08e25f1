import glob
import os
import sys
import uuid
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from article_warehouse import plans, schemas as S  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"

# The time that the seed cases are relative to.
AS_OF = datetime(2026, 5, 22, 3, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(folder / "checkpoint"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.sql.session.timeZone", os.environ.get("TEST_TIME_ZONE", "UTC"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York", "Pacific/Apia"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


@pytest.fixture
def warehouse(spark, tmp_path):
    return new_warehouse(spark, tmp_path)


def new_warehouse(spark, tmp_path, layout=plans.Layout("year")):
    name = f"test_{uuid.uuid4().hex[:12]}"
    return plans.Warehouse(spark, f"{tmp_path}/{name}", name, layout)


def clone(original, tmp_path):
    """A warehouse of its own that starts from the files of ``original``; files never change."""
    spark, copy = original.spark, new_warehouse(original.spark, tmp_path, original.layout)
    spark.sql(f"create database {copy.database} location '{copy.root}'")
    for table in (S.FACT, S.KEYS, S.ROLLUP, S.OUTLIERS, S.DATES, S.AUTHORS, S.CONTROL):
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in {"cloned": "yes", **original._properties(table)}.items())
        spark.sql(
            f"create table {copy.name(table)} like {original.name(table)} using parquet "
            f"location '{_location(original, table)}' tblproperties ({properties})"
        )
    for period, part in original.partitions():
        spec = f"partition (created_period = {period}, key_slice = {part})"
        for table in (S.FACT, S.KEYS, S.ROLLUP, S.OUTLIERS):
            copy._alter(table, f"add {spec} location '{_location(original, table, spec)}'")
    return copy


def _location(warehouse, table, spec=""):
    described = warehouse.spark.sql(f"describe table extended {warehouse.name(table)} {spec}")
    return described.where("col_name = 'Location'").collect()[0]["data_type"]


def local(text):
    """A time of the business zone, as UTC."""
    return datetime.fromisoformat(text) - timedelta(hours=7)


def article(id, created, author=101, title="Title", content="Some text", published=None, updated=None, deleted=None):
    return (id, title, content, published or created, author, created, updated or created, deleted)


def frame(spark, rows):
    return spark.createDataFrame(rows, S.ARTICLES_SCHEMA)


def seed_rows():
    hours = lambda n: AS_OF - timedelta(hours=n)
    return [
        article(1, local("2016-05-03 16:20"), 101, "Reading on screens", published=local("2016-05-03 18:05")),
        article(2, local("2016-09-14 11:10"), 102, "First steps with tables", published=local("2016-09-14 11:15")),
        article(3, local("2016-11-06 07:00"), 101, "Midnight", published=local("2016-11-06 07:30")),
        article(4, local("2020-03-19 20:45"), 103, "Large data", published=local("2020-03-19 21:00")),
        article(5, local("2020-10-08 08:30"), 102, "A guide", published=local("2020-10-08 09:40")),
        article(6, hours(15), 103, "Columns", published=hours(14)),
        article(7, hours(6), 101, "Rows", published=hours(5)),
        article(8, hours(70), 104, "Withdrawn", published=hours(66), updated=hours(30), deleted=hours(30)),
    ]


def sorted_rows(df, *columns):
    columns = columns or sorted(df.columns)
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
