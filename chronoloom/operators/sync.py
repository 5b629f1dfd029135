"""Synchronisation of irregular sensor points onto a regular time grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.numeric import narrow as narrow_value
from chronoloom.functions.timefn import snap
from chronoloom.operators.fill import fill_limited
from chronoloom.operators.reshape import group_mean, pivot_mean
from chronoloom.operators.select import complete_rows
from chronoloom.operators.slots import Depth
from chronoloom.schema import FIELD, SYNC_KEYS, TEMPERATURE_FIELDS, TIME, VALUE


def on_grid(
    points: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = SYNC_KEYS,
    step: str = "5m",
    float32: bool = False,
) -> DataFrame:
    """One row per grid time (epoch seconds) and key set, one mean column per field.

    It is a mean of means: points sharing an instant and keys are averaged first, then the
    instants within a grid step. Both steps combine before they shuffle.
    """
    value = F.col(VALUE).cast("float") if float32 else F.col(VALUE).cast("double")
    narrow_points = points.select(TIME, *keys, FIELD, value.alias(VALUE))
    instants = pivot_mean(narrow_points, [TIME, *keys], fields)
    snapped = instants.withColumn(TIME, snap(F.col(TIME), step))
    return group_mean(snapped, [TIME, *keys], fields, drop_null_keys=False)


def complete_grid(
    grid: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = SYNC_KEYS,
    fill_limit: int = 2,
    fill_scope: str = "system",
    narrow: str | None = None,
    temperatures: Sequence[str] = TEMPERATURE_FIELDS,
    split: str | Depth | None = "1h",
) -> DataFrame:
    """Fill short gaps of a grid table, drop the rows that stay incomplete, narrow the values.

    ``fill_scope="system"`` orders all rows of the first key by time and remaining keys, so a gap
    may be filled from a neighbouring device. ``fill_scope="series"`` fills each device from its
    own rows only. ``split`` cuts the fill into time slots, as in :func:`fill_limited`.
    """
    if fill_scope == "system":
        partition, order = list(keys[:1]), [TIME, *keys[1:]]
    elif fill_scope == "series":
        partition, order = list(keys), [TIME]
    else:
        raise ValueError(f"unknown fill scope {fill_scope!r}")
    filled = fill_limited(grid, partition, order, list(fields), fill_limit, split)
    narrowed = [narrow_value(F.col(f), narrow, f in temperatures).alias(f) for f in fields]
    return complete_rows(filled).select(TIME, *keys, *narrowed)


def synchronise(
    points: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = SYNC_KEYS,
    step: str = "5m",
    fill_limit: int = 2,
    fill_scope: str = "system",
    narrow: str | None = None,
    temperatures: Sequence[str] = TEMPERATURE_FIELDS,
    float32: bool = False,
    split: str | Depth | None = "1h",
) -> DataFrame:
    """Points to complete rows on a regular grid, one column per field, time as epoch seconds."""
    grid = on_grid(points, fields, keys, step, float32)
    return complete_grid(grid, fields, keys, fill_limit, fill_scope, narrow, temperatures, split)


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, column count and total number of nulls, as one row."""
    nulls = [F.count_if(F.col(c).isNull()) for c in columns]
    total = nulls[0]
    for each in nulls[1:]:
        total = total + each
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        total.alias("n_nulls"),
    )
