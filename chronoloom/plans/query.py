"""A series query as data: ordered named steps folded over a point table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.operators import order, select
from chronoloom.operators.fill import difference, fill_previous
from chronoloom.operators.reshape import pivot_last
from chronoloom.operators.window_agg import aggregate_window, expected_windows
from chronoloom.schema import FIELD, MEASUREMENT, VALUE, parse_instant, series_keys

# Series are ordered slot by slot, so that a long one is never ordered in one task. A slot should hold
# many points of a series; a query takes another width as ``slot``.
SLOT = "1d"
# Rows of a series that one task orders: after a window aggregation over a bounded range they are known from the query.
MOST_WINDOWS = 1_000_000


@dataclass(frozen=True)
class Series:
    """A frame, the columns that tell its series apart, and what is known of their extent."""

    df: DataFrame
    keys: tuple[str, ...]
    start: datetime | None = None
    stop: datetime | None = None
    split: str | None = SLOT
    as_of: datetime | None = None
    exclude_buckets: tuple[str, ...] = ()

    def with_df(self, df: DataFrame) -> Series:
        return replace(self, df=df)

    def grouped(self, keys: Iterable[str]) -> Series:
        """The same frame with other series keys."""
        return replace(self, keys=tuple(keys))


def _flag(value) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() == "true"


def _items(args) -> list[Mapping]:
    return list(args) if isinstance(args, (list, tuple)) else [args]


def _names(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _either(series: Series, predicates: list[Column]) -> Series:
    return series.with_df(select.any_of(series.df, *predicates))


def _one_of(argument: str, column: str) -> Callable[[Series, object], Series]:
    def step(series: Series, args) -> Series:
        values = [v for item in _items(args) for v in _names(item[argument])]
        return series.with_df(select.equals(series.df, column, values))

    return step


def _none_of(argument: str, column: str) -> Callable[[Series, object], Series]:
    def step(series: Series, args) -> Series:
        values = [v for item in _items(args) for v in _names(item[argument])]
        return series.with_df(select.not_equals(series.df, column, values))

    return step


def _bucket(series: Series, args) -> Series:
    names = args["bucket"] if isinstance(args, Mapping) else args
    return series.with_df(select.in_buckets(series.df, _names(names), series.exclude_buckets))


def _range(series: Series, args) -> Series:
    start = parse_instant(args["start"], series.as_of) if args.get("start") is not None else None
    stop = parse_instant(args["stop"], series.as_of) if args.get("stop") is not None else None
    ranged = select.time_range(series.df, start, stop)
    return replace(series, df=ranged, start=start, stop=stop)


def _general(series: Series, args) -> Series:
    return _range(_bucket(series, args), args)


def _tag_is(series: Series, args) -> Series:
    return _either(series, [F.col(i["tag_name"]) == i["tag_value"] for i in _items(args)])


def _tag_is_not(series: Series, args) -> Series:
    for item in _items(args):
        series = series.with_df(select.tag_is_not(series.df, item["tag_name"], item["tag_value"]))
    return series


def _between(inclusive: bool) -> Callable[[Series, Mapping], Series]:
    def step(series: Series, args: Mapping) -> Series:
        low, high = float(args["min_value"]), float(args["max_value"])
        return series.with_df(select.value_between(series.df, low, high, inclusive))

    return step


def _contains(series: Series, args: Mapping) -> Series:
    return series.with_df(select.contains(series.df, args["tag_name"], args["set"]))


def _keep(series: Series, args) -> Series:
    columns = _names(args["columns"])
    kept = series.with_df(select.keep(series.df, columns))
    return kept.grouped(k for k in series.keys if k in columns)


def _drop(series: Series, args) -> Series:
    columns = _names(args["columns"])
    dropped = series.with_df(select.drop(series.df, columns))
    return dropped.grouped(k for k in series.keys if k not in columns)


def _group(series: Series, args) -> Series:
    return series.grouped(_names(args["columns"]))


def _sort(series: Series, args) -> Series:
    return series.with_df(order.sort(series.df, _names(args["columns"]), series.keys))


def _pivot(series: Series, args: Mapping) -> Series:
    rows, value = _names(args["row_key"]), args.get("value", VALUE)
    column = _names(args["column_key"])[0]
    wide = pivot_last(series.df, rows, _names(args["fields"]), column, value)
    return replace(series, df=wide, keys=tuple(k for k in series.keys if k in rows))


def _window(series: Series, args: Mapping) -> Series:
    stop = series.stop or series.as_of
    empty = _flag(args.get("create_empty", False))
    windows = aggregate_window(
        series.df, args["every"], args["function"], list(series.keys), empty, series.start, stop
    )
    out = replace(series, df=windows)
    if series.start is not None and stop is not None and expected_windows(series.start, stop, args["every"]) <= MOST_WINDOWS:
        out = replace(out, split=None)  # a series has at most one row a window from here on
    if "rowKey" not in args:
        return out
    wanted = {"row_key": args["rowKey"], "column_key": args["columnKey"], "fields": args["fields"]}
    return _pivot(out, {**wanted, "value": args.get("valueColumn", VALUE)})


def _fill(series: Series, args: Mapping) -> Series:
    columns = _names(args.get("columns", VALUE))
    if not _flag(args.get("previous", True)):
        return series.with_df(series.df.fillna(args["value"], subset=columns))
    return series.with_df(fill_previous(series.df, series.keys, columns, split=series.split))


def _difference(series: Series, args: Mapping) -> Series:
    columns = _names(args.get("columns", VALUE))
    flag = _flag(args.get("non_negative", False))
    return series.with_df(difference(series.df, series.keys, columns, non_negative=flag, split=series.split))


# Step names as plans spell them.
STEPS: dict[str, Callable[[Series, object], Series]] = {
    "general_query": _general,
    "bucket": _bucket,
    "buckets": _bucket,
    "range": _range,
    "last_hours": _range,
    "filter_system_id": _one_of("system_id", "system_id"),
    "filter_measurement": _one_of("measurement", MEASUREMENT),
    "filter_not_measurement": _none_of("measurement", MEASUREMENT),
    "filter_element": _one_of("element", "element"),
    "filter_type": _one_of("type", "type"),
    "filter_field": _one_of("field", FIELD),
    "filter_not_field": _none_of("field", FIELD),
    "tag_is": _tag_is,
    "tag_is_not": _tag_is_not,
    "bewteen_values_included_filter": _between(True),
    "bewteen_values_not_included_filter": _between(False),
    "contains": _contains,
    "keep_columns": _keep,
    "drop_columns": _drop,
    "group": _group,
    "sort": _sort,
    "pivot": _pivot,
    "window_aggregation": _window,
    "fill": _fill,
    "difference": _difference,
}


def ordered_steps(query: Mapping | Iterable[Mapping]) -> list[tuple[str, object]]:
    """Steps of a query given as one mapping in order, or as a list of one-step mappings."""
    parts = [query] if isinstance(query, Mapping) else list(query)
    steps = [(name, args) for part in parts for name, args in part.items()]
    unknown = [name for name, _ in steps if name not in STEPS]
    if unknown:
        raise ValueError(f"unknown step {unknown[0]!r}; known steps: {sorted(STEPS)}")
    return steps


def rerange(steps: list[tuple[str, object]], start=None, stop=None) -> list[tuple[str, object]]:
    """The same steps over another time range; a query without a range step gets one."""
    bounds = {k: v for k, v in (("start", start), ("stop", stop)) if v is not None}
    ranged = ("range", "last_hours", "general_query")
    if bounds and not any(name in ranged for name, _ in steps):
        buckets = [k for k, (name, _) in enumerate(steps) if name in ("bucket", "buckets")]
        at = buckets[0] + 1 if buckets else 0
        return [*steps[:at], ("range", bounds), *steps[at:]]
    return [(name, {**args, **bounds} if name in ranged else args) for name, args in steps]


def run_query(
    points: DataFrame,
    query: Mapping | Iterable[Mapping],
    start=None,
    stop=None,
    keys: Iterable[str] | None = None,
    as_of: str | datetime | None = None,
    exclude_buckets: Iterable[str] = (),
    slot: str = SLOT,
) -> DataFrame:
    """Fold the steps over a point table; ``start`` and ``stop`` replace the saved range.

    ``slot`` is the width of the time slots in which series are filled and differenced.
    """
    series = Series(
        points,
        tuple(keys if keys is not None else series_keys(points)),
        as_of=parse_instant(as_of) if as_of is not None else None,
        exclude_buckets=tuple(exclude_buckets),
        split=slot,
    )
    for name, args in rerange(ordered_steps(query), start, stop):
        series = STEPS[name](series, args)
    return series.df
