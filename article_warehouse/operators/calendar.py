"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from article_warehouse.schemas import ARTICLE_KEY, DATES_SCHEMA

DATE_KEYS = ["published_date_key", "created_date_key"]

# The calendar range of the warehouse, both ends included.
FIRST_DATE = "2015-01-01"
LAST_DATE = "2030-12-31"

# Days of other years get no row, however many articles claim them; star queries count these under an unknown day.
PLAUSIBLE_YEARS = (1970, 2100)

# Fixed values. Formatting a date would pass through the session time zone, where a day can be missing.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def date_dimension(spark: SparkSession, start: str = FIRST_DATE, end: str = LAST_DATE) -> DataFrame:
    """One row per day from ``start`` to ``end`` with its calendar attributes."""
    span = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return calendar_days(span)


def covering_calendar(
    fact: DataFrame, start: str = FIRST_DATE, end: str = LAST_DATE, years: tuple[int, int] = PLAUSIBLE_YEARS
) -> DataFrame:
    """The calendar from ``start`` to ``end``, widened to the date keys of ``fact`` within the given years."""
    keys = [F.when(plausible(F.col(name), years), F.col(name)) for name in DATE_KEYS]
    first, last = key_day(F.min(F.least(*keys))), key_day(F.max(F.greatest(*keys)))
    # Nulls are left out, so an empty fact changes nothing.
    first, last = F.least(F.lit(start).cast("date"), first), F.greatest(F.lit(end).cast("date"), last)
    return calendar_days(fact.agg(first.alias("first_day"), last.alias("last_day")))


def plausible(key: Column, years: tuple[int, int]) -> Column:
    """Whether a date key is in one of the years from the first to the last; null for a missing key."""
    return key.between(years[0] * 10000, years[1] * 10000 + 1231)


def key_outliers(fact: DataFrame, *partition: str, years: tuple[int, int] = PLAUSIBLE_YEARS) -> DataFrame:
    """Articles with a date key in another year."""
    outside = [F.coalesce(~plausible(F.col(name), years), F.lit(False)) for name in DATE_KEYS]
    return fact.where(outside[0] | outside[1]).select(*partition, ARTICLE_KEY, *DATE_KEYS)


def key_day(key: Column) -> Column:
    """The day of a date key such as 20161231."""
    number = key.cast("int")
    return F.make_date(F.floor(number / 10000).cast("int"), F.floor(number / 100 % 100).cast("int"), number % 100)


def _name(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), number)


def calendar_days(span: DataFrame) -> DataFrame:
    """Calendar rows for every day of each ``(first_day, last_day)`` row."""
    day = F.col("date_actual")
    weekday = F.weekday(day) + 1
    attributes = {
        "date_key": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day),
        "date_actual": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": _name(MONTH_NAMES, F.month(day)),
        "day": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": _name(DAY_NAMES, weekday),
        "is_weekend": weekday.isin(6, 7),
    }
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return (
        span.select(F.explode(F.when(F.col("first_day") <= F.col("last_day"), days)).alias("date_actual"))
        .select(*[attributes[field.name].cast(field.dataType).alias(field.name) for field in DATES_SCHEMA.fields])
    )
