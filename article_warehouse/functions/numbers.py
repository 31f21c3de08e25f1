"""Numeric coercion that gives null instead of failing, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def to_long(df: DataFrame, name: str) -> Column:
    """``df[name]`` as a nullable 64-bit integer.

    Text such as ``'12.0'`` counts as 12. Text that is no number, a fraction such as
    12.5 and a value outside 64 bits become null.
    """
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("bigint")
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast("bigint")
    if isinstance(kind, T.DecimalType):
        return F.when(column == F.floor(column), column.try_cast("bigint"))
    as_double = column.try_cast("double")
    from_double = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    if isinstance(kind, T.StringType):
        return F.coalesce(column.try_cast("bigint"), from_double)
    return from_double
