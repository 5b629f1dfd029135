"""Gap filling and differencing within series.

Each operator has two forms with equal results. Without ``split`` a series is ordered in one task,
which suits series of known length, such as the output of a window aggregation over a bounded
range. With ``split`` a series is cut into time slots that are ordered separately, and only a few
rows per slot cross slot borders, so a series holding a large share of the table is spread over
many tasks. The per-series work that remains is bounded by the number of slots in the time range.
Slots have one width or, as ``"100000 rows"``, about equally many rows (see ``slots``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from chronoloom.operators.slots import SLOT as _SLOT
from chronoloom.operators.slots import Depth, with_slot
from chronoloom.schema import TIME, VALUE

_REAL = "__real"


def _fill_limited(df: DataFrame, columns: Sequence[str], limit: int, window, backward: bool) -> DataFrame:
    behind = window.rowsBetween(-limit, 0)
    df = df.withColumns({c: F.last(c, ignorenulls=True).over(behind) for c in columns})
    if not backward:
        return df
    ahead = window.rowsBetween(0, limit)
    return df.withColumns({c: F.first(c, ignorenulls=True).over(ahead) for c in columns})


def fill_limited(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    limit: int = 2,
    split: str | Depth | None = None,
    backward: bool = True,
) -> DataFrame:
    """Forward fill by at most ``limit`` rows, then backward fill by at most ``limit`` rows.

    ``order`` starts with the time column. In the split form a row at least ``limit`` rows away
    from both ends of its slot is final. The rows nearer to an end depend on at most
    ``2 * limit`` rows on either side of the border; those border rows, a fixed number per slot,
    are filled again in series order.
    """
    if split is None:
        return _fill_limited(df, columns, limit, W.partitionBy(*partition).orderBy(*order), backward)

    names = df.columns
    in_slot = W.partitionBy(*partition, _SLOT).orderBy(*order)
    one = F.lit(1)

    def near_an_end(rows: int) -> Column:
        return F.lag(one, rows).over(in_slot).isNull() | F.lead(one, rows).over(in_slot).isNull()

    marked = with_slot(df, partition, order[0], split).withColumns(
        {"__edge": near_an_end(limit), "__border": near_an_end(2 * limit)}
    )
    inner = _fill_limited(marked, columns, limit, in_slot, backward).where(~F.col("__edge"))
    in_series = W.partitionBy(*partition).orderBy(*order)
    edges = _fill_limited(marked.where("__border"), columns, limit, in_series, backward).where("__edge")
    return inner.select(*names).unionByName(edges.select(*names))


def _with_slot_carry(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], split: str | Depth
) -> DataFrame:
    """Add to each slot a leading row that holds the last non-null values of earlier slots.

    The added rows have ``__real = 0``. One is added for every slot but the first of a series.
    """
    slotted = with_slot(df, keys, order[0], split)
    # A single time column keeps the aggregate hash-based; a struct needs sorted input.
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    last_in_slot = slotted.groupBy(*keys, _SLOT).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns]
    )
    by_slot = W.partitionBy(*keys).orderBy(_SLOT)
    earlier = by_slot.rowsBetween(W.unboundedPreceding, -1)
    carry = last_in_slot.select(
        *keys,
        _SLOT,
        *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in columns],
        F.lag(F.lit(0)).over(by_slot).alias(_REAL),
    ).where(F.col(_REAL).isNotNull())
    return slotted.withColumn(_REAL, F.lit(1)).unionByName(carry, allowMissingColumns=True)


def fill_previous(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = (VALUE,),
    order: Sequence[str] = (TIME,),
    split: str | Depth | None = None,
) -> DataFrame:
    """Replace nulls by the last non-null value of the series; leading nulls stay."""
    if split is None:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    rows = _with_slot_carry(df, keys, order, columns, split)
    w = W.partitionBy(*keys, _SLOT).orderBy(_REAL, *order).rowsBetween(W.unboundedPreceding, 0)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    return filled.where(F.col(_REAL) == 1).select(*df.columns)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    order: Sequence[str] = (TIME,),
    split: str | Depth | None = None,
    first_flag: str | None = None,
) -> DataFrame:
    """Add, per ``{source: name}``, the last non-null source value before each row of its series.

    ``first_flag`` names an added boolean column that marks the first row of each series.
    """
    sources = list(columns)
    extra = list(columns.values()) + ([first_flag] if first_flag else [])
    if split is None:
        rows, w = df, W.partitionBy(*keys).orderBy(*order)
    else:
        rows = _with_slot_carry(df, keys, order, sources, split)
        w = W.partitionBy(*keys, _SLOT).orderBy(_REAL, *order)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    added = {name: F.last(source, ignorenulls=True).over(before) for source, name in columns.items()}
    if first_flag:
        added[first_flag] = F.lag(F.lit(1)).over(w).isNull()
    out = rows.withColumns(added)
    if split is not None:
        out = out.where(F.col(_REAL) == 1)
    return out.select(*df.columns, *extra)


def difference(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = (VALUE,),
    order: Sequence[str] = (TIME,),
    non_negative: bool = False,
    split: str | Depth | None = None,
) -> DataFrame:
    """Value minus the last non-null value before it; the first row of each series is dropped.

    With ``non_negative`` a falling value, such as a meter reset, gives null.
    """
    previous = {c: f"__previous_{i}" for i, c in enumerate(columns)}
    rows = with_previous(df, keys, previous, order, split, first_flag="__first").where(~F.col("__first"))
    deltas = {}
    for column, name in previous.items():
        delta = F.col(column) - F.col(name)
        deltas[column] = F.when(delta >= 0, delta) if non_negative else delta
    return rows.withColumns(deltas).select(*df.columns)


def with_lags(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    lags: dict[str, int],
    order: Sequence[str] = (TIME,),
    split: str | Depth | None = None,
) -> DataFrame:
    """Add, per ``{name: n}``, the value of ``column`` ``n`` rows before each row of its series."""
    return _looking_back(df, keys, order, split, max(lags.values(), default=1), lambda w: {name: F.lag(column, n).over(w) for name, n in lags.items()})


def with_recent(
    df: DataFrame, keys: Sequence[str], column: str, rows: int, name: str, order: Sequence[str] = (TIME,), split: str | Depth | None = None
) -> DataFrame:
    """Add the values of ``column`` in the last ``rows`` rows of the series, the row itself included, as an array without nulls."""
    if rows < 1:
        raise ValueError("the row itself is one of its recent rows")
    return _looking_back(df, keys, order, split, max(rows - 1, 1), lambda w: {name: F.collect_list(column).over(w.rowsBetween(1 - rows, 0))})


def _looking_back(df: DataFrame, keys, order, split, most: int, added: Callable[[WindowSpec], dict[str, Column]]) -> DataFrame:
    """Add columns that depend on a row and at most ``most`` rows before it.

    In the split form the first rows of a slot, as many as that, look back over its border; these and the last
    rows of every slot are put into series order once more, a fixed number per slot.
    """
    in_series = W.partitionBy(*keys).orderBy(*order)
    if split is None:
        return df.withColumns(added(in_series))
    one, in_slot = F.lit(1), W.partitionBy(*keys, _SLOT).orderBy(*order)
    early = F.lag(one, most).over(in_slot).isNull()
    marked = with_slot(df, keys, order[0], split).withColumns({"__early": early, "__border": early | F.lead(one, most).over(in_slot).isNull()})
    names = [*df.columns, *added(in_slot)]
    inner = marked.withColumns(added(in_slot)).where(~F.col("__early"))
    border = marked.where("__border").withColumns(added(in_series)).where("__early")
    return inner.select(*names).unionByName(border.select(*names))
