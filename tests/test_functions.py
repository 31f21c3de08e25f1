from datetime import datetime

import pytest
from pyspark.sql import functions as F

from article_warehouse.functions import (
    char_count,
    date_key,
    instant,
    text_or_empty,
    to_long,
    to_utc,
    utc_naive,
    word_count,
)

TEXTS = [
    "",
    "   ",
    "one",
    " two  words ",
    "a\tb\nc\rd\x0be\x0cf",
    "a\xa0b",
    "a　b c d",
    "a\x1cb\x1dc\x1ed\x1fe",
    "a\x85b",
    "a​b",
    "a b c d e",
    "\U0001f600 smile",
    "\xa0lead and trail ",
    "x\x00y z",
]


def test_word_and_char_count_agree_with_python(spark):
    df = spark.createDataFrame([(text,) for text in TEXTS], "text string")
    rows = df.select("text", word_count(F.col("text")).alias("w"), char_count(F.col("text")).alias("c")).collect()
    assert [(r.text, r.w, r.c) for r in rows] == [(t, len(t.split()), len(t)) for t in TEXTS]


def test_missing_text_counts_as_empty(spark):
    row = (
        spark.createDataFrame([(None,)], "text string")
        .select(
            text_or_empty(F.col("text")).alias("t"),
            word_count(F.col("text")).alias("w"),
            char_count(F.col("text")).alias("c"),
        )
        .first()
    )
    assert tuple(row) == ("", 0, 0)


TIME_TEXTS = {
    "2016-12-18 07:00:00+07": datetime(2016, 12, 18),
    "2016-12-18 07:00:00+0700": datetime(2016, 12, 18),
    "2016-12-18T07:00:00.123456+07:00": datetime(2016, 12, 18, 0, 0, 0, 123456),
    "2016-12-18 07:00+07:00": datetime(2016, 12, 18),
    "2016-12-18T07:00Z": datetime(2016, 12, 18, 7),
    "2016-12-18T07:00:00Z": datetime(2016, 12, 18, 7),
    "2016-12-18 07:00:00 UTC": datetime(2016, 12, 18, 7),
    "2016-12-18 07:00:00 Asia/Jakarta": datetime(2016, 12, 18),
    "2016-12-18 07:00:00-05:00": datetime(2016, 12, 18, 12),
    "2016-12-18 07:00:00": datetime(2016, 12, 18, 7),
    "2016-12-18 07:00": datetime(2016, 12, 18, 7),
    "2016-12-18 07:00:00.5": datetime(2016, 12, 18, 7, 0, 0, 500000),
    "2016-12-18": datetime(2016, 12, 18),
    "2016-12-18 ": datetime(2016, 12, 18),
    "2011-12-30 10:00:00": datetime(2011, 12, 30, 10),
    "1931-03-01 00:00:00+00": datetime(1931, 3, 1),
    "2016-02-30 00:00:00": None,
    "2016-12-18 07:00:00 Nowhere": None,
    "10:00:00": None,
    "10:00:00+07": None,
    "not a time": None,
    "": None,
    None: None,
}


def test_text_becomes_utc_in_any_session_zone(spark, zone):
    df = spark.createDataFrame([(text,) for text in TIME_TEXTS], "t string")
    found = {row.t: row.utc for row in df.select("t", to_utc(df, "t").alias("utc")).collect()}
    assert found == TIME_TEXTS


def test_instants_become_utc_in_any_session_zone(spark, zone):
    # 2016-11-06 06:30Z lies in the hour that New York repeats.
    times = ["2016-11-06 05:30:00", "2016-11-06 06:30:00", "2011-12-30 10:00:00", "1900-01-01 00:00:00"]
    df = spark.range(1).select(F.explode(F.array(*[F.lit(t + "Z").cast("timestamp") for t in times])).alias("t"))
    assert [row[0] for row in df.select(to_utc(df, "t")).collect()] == [datetime.fromisoformat(t) for t in times]


def test_literals_follow_the_column_type(spark, zone):
    value = datetime(2016, 11, 6, 6, 30)
    df = spark.range(1).select(F.lit("2016-11-06T06:30:00Z").cast("timestamp").alias("z"), instant(value).alias("n"))
    same = (F.col("z") == instant(value, df.schema["z"].dataType)) & (F.col("n") == instant(value))
    assert df.where(same).count() == 1


def test_date_key_uses_the_business_calendar(spark, zone):
    cases = {
        datetime(2016, 12, 17, 16, 59, 59): 20161217,
        datetime(2016, 12, 17, 17, 0): 20161218,
        datetime(2011, 12, 30, 0, 0): 20111230,
        datetime(2016, 12, 31, 23, 0): 20170101,
        None: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t timestamp_ntz")
    assert [row[0] for row in df.select(date_key(F.col("t"))).collect()] == list(cases.values())
    assert df.select(date_key(F.col("t"), "UTC")).first()[0] == 20161217


def test_numeric_coercion_of_text(spark):
    cases = {"12": 12, "12.0": 12, " 7 ": 7, "12.5": None, "x": None, "": None, "9223372036854775807": 2**63 - 1,
             "1e3": 1000, "1e30": None, "NaN": None, "-3": -3}
    df = spark.createDataFrame([(t,) for t in cases], "a string")
    assert [row[0] for row in df.select(to_long(df, "a")).collect()] == list(cases.values())


@pytest.mark.parametrize(
    ("kind", "cases"),
    [
        ("int", [(7, 7), (None, None)]),
        ("double", [(7.0, 7), (7.5, None), (1e30, None), (float("nan"), None), (None, None)]),
        ("boolean", [(True, 1), (None, None)]),
    ],
)
def test_numeric_coercion_of_numbers(spark, kind, cases):
    df = spark.createDataFrame([(value,) for value, _ in cases], f"a {kind}")
    assert [row[0] for row in df.select(to_long(df, "a")).collect()] == [expected for _, expected in cases]


def test_numeric_coercion_of_decimals(spark):
    df = spark.sql("select explode(array(7.00, 7.50, null, 99999999999999999999.00)) as a")
    assert [row[0] for row in df.select(to_long(df, "a")).collect()] == [7, None, None, None]


def test_python_times_are_utc():
    assert utc_naive("2016-12-18T07:00:00+07:00") == datetime(2016, 12, 18)
    assert utc_naive(datetime(2016, 12, 18)) == datetime(2016, 12, 18)
