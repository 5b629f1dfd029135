"""Slots: stretches of time into which a series is cut, so that many tasks can order it.

A slot is a number that never falls as time goes on within a series, and rows of one instant share it. Operators that order
rows (`fill`) give the same result for any slots. Slots of one width suit series of even density. Slots by counts take their
borders from a histogram of each series: dense hours are cut, sparse ones put together, and a series with few rows is one slot.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.functions.timefn import epoch_micros, epoch_seconds, floor_seconds
from chronoloom.schema import duration_seconds, type_of

SLOT = "__slot"

_BY_COUNT = re.compile(r"(\d+)\s*rows(?:\s+by\s+(.+))?")


@dataclass(frozen=True)
class Depth:
    """Slots of about ``rows`` rows, from counts in bins of a width; a bin that holds more is cut evenly in time.

    The narrower the bin, the closer slots come to ``rows`` where points bunch within it, and the larger the histogram, which has a
    row for each bin that a series uses.
    """

    rows: int
    bin: str = "1h"


def _numeric(df: DataFrame, time: str) -> bool:
    return type_of(df, time).typeName() in ("long", "integer")


def time_slot(df: DataFrame, time: str, split: str) -> Column:
    """The slot of one width a row falls in: its time, epoch seconds if the column is numeric, floored."""
    return floor_seconds(F.col(time) if _numeric(df, time) else epoch_seconds(F.col(time)), split)


def parsed(split: str | Depth) -> str | Depth:
    """``"1h"`` is a width; ``"100000 rows"`` and ``"100000 rows by 5m"`` are slots by counts."""
    match = _BY_COUNT.fullmatch(split.strip()) if isinstance(split, str) else None
    if not match:
        return split
    return Depth(int(match[1]), match[2] or Depth.bin)


def histogram(df: DataFrame, keys: Sequence[str], time: str, depth: Depth) -> DataFrame:
    """The bins of the series that need more than one slot: ``k``, ``bin``, the first slot, and into how many pieces the bin is cut.

    Counts are combined before the shuffle. The running sum of a series goes over its bins, whose number depends on the time range only.
    """
    unit, tick = (1, F.col(time).cast("long")) if _numeric(df, time) else (1_000_000, epoch_micros(F.col(time)))
    width = duration_seconds(depth.bin) * unit
    ticks = df.select(F.struct(*keys).alias("k"), tick.alias("t"), F.floor(tick / width).alias("bin")).where("t IS NOT NULL")
    counts = ticks.groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("k").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = counts.select("*", before.alias("before"), F.sum("n").over(W.partitionBy("k")).alias("total"))
    pieces = F.ceil(F.col("n") / depth.rows)
    return placed.where(F.col("total") > depth.rows).select(
        "k", "bin", F.floor(F.col("before") / depth.rows).alias("first"), pieces.alias("pieces"), "low", (F.col("high") - F.col("low") + 1).alias("span")
    )


def with_slot(df: DataFrame, keys: Sequence[str], time: str, split: str | Depth) -> DataFrame:
    """``df`` with the slot of every row. Slots by counts read ``df`` twice."""
    split = parsed(split)
    if isinstance(split, str):
        return df.withColumn(SLOT, time_slot(df, time, split))
    bins = histogram(df, keys, time, split).select(F.col("k").alias("__k"), F.col("bin").alias("__bin"), "first", "pieces", "low", "span")
    unit, tick = (1, F.col(time).cast("long")) if _numeric(df, time) else (1_000_000, epoch_micros(F.col(time)))
    rows = df.select("*", F.struct(*keys).alias("__rk"), F.floor(tick / (duration_seconds(split.bin) * unit)).alias("__rbin"), tick.alias("__tick"))
    piece = F.expr("((__tick - low) * pieces) div span")
    slotted = rows.join(bins, (F.col("__rk") == F.col("__k")) & (F.col("__rbin") == F.col("__bin")), "left")
    return slotted.select(*df.columns, F.coalesce(F.col("first") + piece, F.lit(0)).cast("bigint").alias(SLOT))
