"""Aggregation over fixed time windows, with or without empty windows."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.functions.timefn import epoch_seconds, from_epoch_seconds
from chronoloom.operators.quantiles import quantiles
from chronoloom.operators.select import time_range
from chronoloom.schema import TIME, VALUE, duration_seconds, epoch_of, instant_literal, parse_instant, type_of

_END = "__end"

# Ties in time are settled by value, so that results repeat.
AGGREGATES: dict[str, Callable[[Column, Column], Column]] = {
    "mean": lambda v, t: F.avg(v),
    "max": lambda v, t: F.max(v),
    "min": lambda v, t: F.min(v),
    "sum": lambda v, t: F.sum(v),
    "count": lambda v, t: F.count(v),
    "stddev": lambda v, t: F.stddev_samp(v),
    "spread": lambda v, t: F.max(v) - F.min(v),
    "first": lambda v, t: F.min_by(v, F.when(v.isNotNull(), F.struct(t, v))),
    "last": lambda v, t: F.max_by(v, F.when(v.isNotNull(), F.struct(t, v))),
}


def window_end(time: str, every: str) -> Column:
    """End of the epoch-aligned window that holds a time, as epoch seconds."""
    step = duration_seconds(every)
    seconds = epoch_seconds(F.col(time))
    return seconds - F.pmod(seconds, F.lit(step)) + F.lit(step)


def _aggregate(df: DataFrame, ends: Sequence[str], functions: Sequence[str], time: str, value: str) -> DataFrame:
    plain = [f for f in functions if f != "median"]
    unknown = [f for f in plain if f not in AGGREGATES]
    if unknown:
        raise ValueError(f"unknown window function {unknown[0]!r}")
    v, t = F.col(value), F.col(time)
    # The count keeps windows whose median is null.
    out = df.groupBy(*ends).agg(*[AGGREGATES[f](v, t).alias(f"__{f}") for f in plain or ["count"]])
    if "median" in functions:
        medians = quantiles(df, ends, value, {"__median": 0.5})
        right = medians.select(*[F.col(e).alias(f"__r_{e}") for e in ends], "__median")
        same = reduce(and_, [F.col(e).eqNullSafe(F.col(f"__r_{e}")) for e in ends])
        out = out.join(right, same, "left")
    return out.select(*ends, *[f"__{f}" for f in functions])


def _with_empty_windows(
    df: DataFrame, keys: Sequence[str], values: dict[str, Column], every: str, start: datetime, stop: datetime
) -> DataFrame:
    """Add the missing windows of each series that has any row.

    Every row is repeated up to the next one of its series, and the first row also back to the
    start, so no separate grid is built or joined. A series holds at most one row per window of
    the range, which bounds both the ordering and the repetition. The rows are spread over a fixed
    number of partitions first: sizes seen before the repetition would merge them into too few.
    """
    step = duration_seconds(every)
    first = (math.floor(epoch_of(start) / step) + 1) * step
    last = math.ceil(epoch_of(stop) / step) * step
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartition(partitions, *keys)
    w = W.partitionBy(*keys).orderBy(_END)
    origin = F.when(F.lag(_END).over(w).isNull(), F.lit(first)).otherwise(F.col(_END))
    until = F.coalesce(F.lead(_END).over(w) - F.lit(step), F.lit(last))
    repeated = spread.withColumns({"__from": origin, "__until": until}).select(
        "*", F.explode(F.sequence(F.col("__from"), F.col("__until"), F.lit(step).cast("long"))).alias("__at")
    )
    own = F.col("__at") == F.col(_END)
    filled = [F.when(own, F.col(name)).otherwise(empty).alias(name) for name, empty in values.items()]
    return repeated.select(*keys, F.col("__at").alias(_END), *filled)


def aggregate_window(
    df: DataFrame,
    every: str,
    fn: str | Sequence[str],
    keys: Sequence[str],
    create_empty: bool = False,
    start: str | int | datetime | None = None,
    stop: str | int | datetime | None = None,
    time: str = TIME,
    value: str = VALUE,
) -> DataFrame:
    """Aggregate each series over windows of ``every``; the result time is the window end.

    One function keeps the value column's name; a list gives one column per function. Windows are
    aligned to the epoch, and the last one ends at ``stop`` when that is given. ``create_empty``
    needs both bounds and adds null rows, or zero counts, for windows without points; points outside
    the bounds are then left out.
    """
    functions = [fn] if isinstance(fn, str) else list(fn)
    kind = type_of(df, time)
    if create_empty and start is not None and stop is not None:
        df = time_range(df, parse_instant(start), parse_instant(stop), time=time)
    ended = df.withColumn(_END, window_end(time, every))
    out = _aggregate(ended, [*keys, _END], functions, time, value)
    if create_empty:
        if start is None or stop is None:
            raise ValueError("empty windows need a bounded range")
        empties = {f"__{f}": F.lit(0) if f == "count" else F.lit(None) for f in functions}
        out = _with_empty_windows(out, keys, empties, every, parse_instant(start), parse_instant(stop))
    end = from_epoch_seconds(F.col(_END), kind)
    if stop is not None:
        end = F.least(end, instant_literal(parse_instant(stop), kind))
    names = [value] if isinstance(fn, str) else functions
    columns = [F.col(f"__{f}").alias(n) for f, n in zip(functions, names)]
    return out.select(*keys, end.alias(time), *columns)


def expected_windows(start: datetime, stop: datetime, every: str) -> int:
    """Number of windows that a bounded range touches."""
    step = timedelta(seconds=duration_seconds(every)).total_seconds()
    return math.ceil(epoch_of(stop) / step) - math.floor(epoch_of(start) / step)
