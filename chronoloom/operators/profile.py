"""Table profiles and result views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.quantiles import quantiles
from chronoloom.operators.select import numeric_columns, rows_with_missing

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _as_text(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """(column, value) rows with every value as text."""
    names = list(columns or df.columns)
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    return texts.unpivot([], names, "column", "value")


def column_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct values of each column with their row counts, values as text."""
    return _as_text(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, exact: Sequence[str] = ()) -> DataFrame:
    """Per column: type, row count, null count, number of distinct values; a row per column on empty tables too.

    Distinct values are sketched in a single pass, but for the columns named in ``exact``. Those are
    counted value by value, so that a frequent value is combined before the shuffle.
    """
    names = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    parts = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("n_nulls"),
            (F.lit(None).cast("long") if c in exact else F.approx_count_distinct(f"`{c}`")).alias("n_distinct"),
        )
        for c in names
    ]
    rows = df.agg(F.array(*parts).alias("__columns")).select(F.inline("__columns"))
    counted = [c for c in names if c in exact]
    if counted:
        distinct = column_values(df, counted).groupBy("column").agg(F.count("value").alias("counted"))
        count = F.when(F.col("column").isin(counted), F.coalesce("counted", F.lit(0))).otherwise(F.col("n_distinct"))
        rows = rows.join(distinct, "column", "left").withColumn("n_distinct", count).drop("counted")
    type_of_column = F.create_map(*[F.lit(x) for name in names for x in (name, types[name])])
    return rows.select("column", type_of_column[F.col("column")].alias("dtype"), "n_rows", "n_nulls", "n_distinct")


def column_types(df: DataFrame) -> DataFrame:
    """One row per column with its type, read from the schema."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, minimum, quartiles, maximum.

    Exact quartiles take three more passes over the table; ``exact=False`` reads sketched ones off
    the same single pass as the rest.
    """
    names = list(columns or numeric_columns(df))
    numbers = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in names])
    parts = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
            *([] if exact else [F.percentile_approx(c, p).alias(q) for q, p in QUARTILES.items()]),
        )
        for c in names
    ]
    moments = numbers.agg(F.array(*parts).alias("__columns")).select(F.inline("__columns"))
    shown = ["column", "count", "mean", "std", "min", *QUARTILES, "max"]
    if not exact:
        return moments.select(*shown)
    quartiles = quantiles(numbers.unpivot([], names, "column", "value"), ["column"], "value", QUARTILES)
    # One row per column of the schema on both sides.
    return moments.join(F.broadcast(quartiles), "column", "left").select(*shown)


def result_views(df: DataFrame) -> dict[str, DataFrame]:
    """What the result page shows of one analysis: table, rows with gaps, types, description."""
    return {
        "table": df,
        "missing": rows_with_missing(df),
        "dtypes": column_types(df),
        "description": describe(df),
    }
