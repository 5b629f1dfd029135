"""Filters, projections and discovery on long-form point tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.schema import BUCKET, FIELD, TIME, VALUE, instant_literal, parse_instant, type_of

# Plan words that stand for every bucket.
ALL_BUCKETS = ("all", "all_buckets")


def _as_list(values) -> list:
    return list(values) if isinstance(values, (list, tuple, set)) else [values]


def in_buckets(df: DataFrame, buckets: str | Iterable[str], exclude: Iterable[str] = ()) -> DataFrame:
    """Rows of the named buckets; ``"all"`` keeps every bucket that discovery would list.

    Every form is a plain predicate on the bucket column, so a table partitioned by bucket is pruned.
    """
    names = _as_list(buckets)
    if any(name in ALL_BUCKETS for name in names):
        return _visible_buckets(df, exclude)
    return equals(df, BUCKET, names)


def _visible_buckets(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    df = df.where(~F.col(BUCKET).startswith("_"))
    exclude = list(exclude)
    return df.where(~F.col(BUCKET).isin(exclude)) if exclude else df


def bucket_names(df: DataFrame, exclude: Iterable[str] | DataFrame = ()) -> DataFrame:
    """Bucket discovery: distinct names, minus an exclusion list and names starting with ``_``."""
    if isinstance(exclude, DataFrame):
        names = _visible_buckets(df, ()).select(BUCKET).distinct()
        return names.join(exclude.select(BUCKET).distinct(), BUCKET, "left_anti")
    return _visible_buckets(df, exclude).select(BUCKET).distinct()


def field_keys(df: DataFrame, as_of: str | datetime, days: int = 100) -> DataFrame:
    """Distinct field names seen in the ``days`` before ``as_of``."""
    end = parse_instant(as_of)
    recent = time_range(df, end - timedelta(days=days), end)
    return recent.select(FIELD).distinct()


def time_range(
    df: DataFrame,
    start: str | int | datetime | None = None,
    stop: str | int | datetime | None = None,
    as_of: datetime | None = None,
    time: str = TIME,
) -> DataFrame:
    """Rows with ``start <= time < stop``; an end that is not given is open, and rows without a time lie in no bounded range."""
    kind = type_of(df, time)
    if start is not None:
        df = df.where(F.col(time) >= instant_literal(parse_instant(start, as_of), kind))
    if stop is not None:
        df = df.where(F.col(time) < instant_literal(parse_instant(stop, as_of), kind))
    return df


def equals(df: DataFrame, column: str, values) -> DataFrame:
    """``column`` equals a value, or any one of a list."""
    values = _as_list(values)
    if len(values) == 1:
        return df.where(F.col(column) == values[0])
    return df.where(F.col(column).isin(values))


def not_equals(df: DataFrame, column: str, values) -> DataFrame:
    """``column`` differs from a value, or from every one of a list."""
    values = _as_list(values)
    if len(values) == 1:
        return df.where(F.col(column) != values[0])
    return df.where(~F.col(column).isin(values))


def any_of(df: DataFrame, *predicates: Column) -> DataFrame:
    return df.where(reduce(or_, predicates))


def tag_is(df: DataFrame, tag_name: str, tag_value) -> DataFrame:
    return equals(df, tag_name, tag_value)


def tag_is_not(df: DataFrame, tag_name: str, tag_value) -> DataFrame:
    return not_equals(df, tag_name, tag_value)


def value_between(df: DataFrame, low: float, high: float, inclusive: bool = True, value: str = VALUE) -> DataFrame:
    column = F.col(value)
    if inclusive:
        return df.where((column >= low) & (column <= high))
    return df.where((column > low) & (column < high))


def contains(df: DataFrame, column: str, members: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in a literal list, or in the first column of another frame.

    A frame becomes a left semi join; whether it is broadcast is left to its size at run time.
    """
    if isinstance(members, DataFrame):
        wanted = members.select(F.col(members.columns[0]).alias(column))
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(list(members)))


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, in table order; names the table lacks are ignored."""
    wanted = set(columns)
    return df.select(*[c for c in df.columns if c in wanted])


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def with_bucket(df: DataFrame, name: str) -> DataFrame:
    """Tag every row with a bucket name."""
    return df.withColumn(BUCKET, F.lit(name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    missing = F.col(column).isNull()
    if isinstance(type_of(df, column), (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no missing value."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def rows_with_missing(df: DataFrame) -> DataFrame:
    """The numeric columns of the rows in which at least one of them is missing."""
    columns = numeric_columns(df)
    if not columns:
        return df.select().limit(0)
    return df.where(reduce(or_, [is_missing(df, c) for c in columns])).select(*columns)
