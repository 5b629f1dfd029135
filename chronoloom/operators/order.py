"""Ordering and row limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.session import scratch_path


def sort(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), total: bool = True) -> DataFrame:
    """Order by series keys, then columns; ``total=False`` orders within partitions only."""
    by = [*keys, *[c for c in columns if c not in keys]]
    return df.orderBy(*by) if total else df.sortWithinPartitions(*by)


def limit(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; with ``order`` the choice repeats."""
    return (df.orderBy(*order) if order else df).limit(n)


def numbered(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` with every row's place from 1 in the order of ``columns``, which must tell rows apart for places to repeat.

    The ordered rows are written to the shared folder with their partition and place in it, so no task holds them all; a running sum over
    the partitions' row counts does the rest.
    """
    low_bits = F.lit((1 << 33) - 1)
    at = F.monotonically_increasing_id()
    path = scratch_path(df.sparkSession, "ordered")
    df.orderBy(*columns).select("*", F.shiftright(at, 33).alias("__part"), at.bitwiseAND(low_bits).alias("__at")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("__before"))  # a row for each partition
    return rows.join(starts, "__part").select(*df.columns, (F.col("__before") + F.col("__at") + 1).alias(name))
