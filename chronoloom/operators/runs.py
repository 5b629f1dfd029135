"""Runs: stretches of rows in a row for which a condition holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.functions.timefn import epoch_micros
from chronoloom.operators.slots import SLOT, Depth, with_slot
from chronoloom.schema import TIME, duration_seconds


def condition_runs(
    df: DataFrame, keys: Sequence[str], condition: Column, order: Sequence[str] = (TIME,), split: str | Depth = "1d"
) -> DataFrame:
    """The longest stretches of rows of a series, in ``order``, for which ``condition`` holds: keys, ``start``, ``end``, ``n_rows``.

    ``start`` and ``end`` are the times of the first and last row. A condition that is null does not hold. Runs are found slot by
    slot. Those that touch neither end of their slot are done; the first and last stretch of every slot, two a slot at most, are
    joined over the borders in series order, so a run over many slots is one row and no task orders a whole series.
    """
    time = order[0]
    in_slot = W.partitionBy(*keys, SLOT).orderBy(*order)
    rows = with_slot(df.withColumn("__holds", F.coalesce(condition, F.lit(False))), keys, time, split)
    changed = rows.withColumn("__change", F.when(F.col("__holds") == F.lag("__holds").over(in_slot), 0).otherwise(1))
    numbered = changed.withColumn("__run", F.sum("__change").over(in_slot.rowsBetween(W.unboundedPreceding, 0)))
    stretches = numbered.groupBy(*keys, SLOT, "__run").agg(
        F.first("__holds").alias("holds"), F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n_rows")
    )
    of_slot = W.partitionBy(*keys, SLOT)
    placed = stretches.select("*", (F.col("__run") == 1).alias("opens"), (F.col("__run") == F.max("__run").over(of_slot)).alias("closes"))
    inner = placed.where("holds AND NOT opens AND NOT closes")
    in_series = W.partitionBy(*keys).orderBy(SLOT, "__run")
    border = placed.where("opens OR closes")
    goes_on = F.col("holds") & F.col("opens") & F.lag(F.col("holds") & F.col("closes")).over(in_series)
    border = border.withColumn("__begins", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    border = border.withColumn("__joined", F.sum("__begins").over(in_series.rowsBetween(W.unboundedPreceding, 0)))
    joined = border.where("holds").groupBy(*keys, "__joined").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_rows").alias("n_rows"))
    names = [*keys, "start", "end", "n_rows"]
    return inner.select(*names).unionByName(joined.select(*names))


def run_seconds() -> Column:
    """Seconds between the first and the last row of a run."""
    return (epoch_micros(F.col("end")) - epoch_micros(F.col("start"))) / F.lit(1e6)


def lasting(runs: DataFrame, span: str) -> DataFrame:
    """Runs that last at least ``span``, with their ``seconds``."""
    return runs.withColumn("seconds", run_seconds()).where(F.col("seconds") >= duration_seconds(span))
