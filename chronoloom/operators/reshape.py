"""Long to wide, wide to long, and group means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.schema import BUCKET, FIELD, TIME, VALUE, type_of


def _not_missing(df: DataFrame, column: str) -> Column:
    present = F.col(column).isNotNull()
    if isinstance(type_of(df, column), (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(column)
    return present


def pivot_mean(
    df: DataFrame, index: Sequence[str], fields: Sequence[str], column: str = FIELD, value: str = VALUE
) -> DataFrame:
    """One row per index, one column per field, values averaged.

    Rows with a missing key or value are dropped first. Conditional averages need one shuffle and
    combine on the map side, whatever the number of fields.
    """
    keyed = df.dropna(subset=list(index)).where(_not_missing(df, value) & F.col(column).isin(list(fields)))
    return keyed.groupBy(*index).agg(*[F.avg(F.when(F.col(column) == f, F.col(value))).alias(f) for f in fields])


def pivot_last(
    df: DataFrame,
    row_key: Sequence[str],
    fields: Sequence[str],
    column: str = FIELD,
    value: str = VALUE,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per row key, one column per field, holding the last value by ``order``.

    Values sharing a row key and order are settled by taking the greatest.
    """
    rank = F.struct(*[F.col(c) for c in order], F.col(value))
    return (
        df.where(F.col(column).isin(list(fields)))
        .groupBy(*row_key)
        .agg(*[F.max_by(F.col(value), F.when(F.col(column) == f, rank)).alias(f) for f in fields])
    )


def group_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str], drop_null_keys: bool = True) -> DataFrame:
    """Mean of each column per key, nulls skipped, rows with a null key dropped."""
    keyed = df.dropna(subset=list(keys)) if drop_null_keys else df
    return keyed.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def wide_to_points(
    df: DataFrame,
    ids: Sequence[str],
    fields: Sequence[str],
    field_name: str = FIELD,
    value_name: str = VALUE,
) -> DataFrame:
    """One row per id and non-null field. Fields of mixed types become text, numbers double."""
    kinds = {type(type_of(df, f)) for f in fields}
    numeric = all(issubclass(k, T.NumericType) for k in kinds)
    target = "double" if numeric else "string"
    if len(kinds) == 1 and not numeric:
        target = type_of(df, fields[0])
    narrowed = df.select(*ids, *[F.col(f).cast(target).alias(f) for f in fields])
    return narrowed.unpivot(list(ids), list(fields), field_name, value_name).where(F.col(value_name).isNotNull())


def plot_series(df: DataFrame, columns: Sequence[str], bucket: str = BUCKET, x: str = TIME) -> DataFrame:
    """Long (name, x, y) rows, one series per bucket and column, named ``bucket-column``."""
    typed = df.select(bucket, x, *[F.col(c).cast("double").alias(c) for c in columns])
    long = typed.unpivot([bucket, x], list(columns), "column", "y")
    return long.select(F.concat_ws("-", bucket, "column").alias("name"), F.col(x).alias("x"), "y")
