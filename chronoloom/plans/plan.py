"""Plans: named data sources with their queries, and the chain of stages fitted on their data."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from chronoloom.operators.fuse import fuse
from chronoloom.operators.select import time_range
from chronoloom.plans.query import run_query
from chronoloom.schema import TIME, parse_instant
from chronoloom.sources.files import read_local
from chronoloom.sources.relational import run_sql

# What every plan entry must hold.
REQUIRED = ("steps", "data_sources")

# A source loads the query of a plan: (spark, query, params, start, stop) -> frame, or None if empty.
Source = Callable[[SparkSession, object, Mapping, object, object], DataFrame | None]


def check_plan(plan: Mapping) -> Mapping:
    """Every mapping in the plan must name its steps and data sources."""
    for name, entry in plan.items():
        missing = [k for k in REQUIRED if isinstance(entry, Mapping) and k not in entry]
        if missing:
            raise ValueError(f"plan {name!r} lacks {', '.join(missing)}")
    return plan


def read_plan(spark: SparkSession, path: str) -> Mapping:
    text = "\n".join(row[0] for row in spark.read.text(path, wholetext=True).collect())
    return check_plan(json.loads(text))


def fill_parameters(query, params: Mapping):
    """The query with every ``"{name}"`` argument replaced by the parameter of that name."""
    if isinstance(query, Mapping):
        return {k: fill_parameters(v, params) for k, v in query.items()}
    if isinstance(query, (list, tuple)):
        return [fill_parameters(v, params) for v in query]
    if isinstance(query, str) and query.startswith("{") and query.endswith("}"):
        return params.get(query[1:-1], query)
    if isinstance(query, str):
        for name, value in params.items():
            query = query.replace("{" + name + "}", str(value))
    return query


def filled_sources(entry: Mapping) -> dict:
    """The queries of a plan entry with their parameters: steps filled in, SQL with its parameters beside it.

    Parameters of a source are looked up under its name in the first step.
    """
    first = next(iter(entry.get("steps", {}).values()), {})
    found = {}
    for name, query in entry["data_sources"].items():
        params = first.get(name, {})
        if _is_sql(query):
            lines = [query] if isinstance(query, str) else list(query)
            found[name] = {"sql": lines, "params": dict(params)} if params else query
        else:
            found[name] = fill_parameters(query, params)
    return found


def _is_sql(query) -> bool:
    return isinstance(query, str) or isinstance(query, (list, tuple)) and bool(query) and all(isinstance(q, str) for q in query)


def _load_series(table, keys, exclude, as_of, spark, query, params, start, stop) -> DataFrame:
    points = table() if callable(table) else table
    return run_query(points, fill_parameters(query, params), start, stop, keys, as_of, exclude)


def series_source(
    table: DataFrame | Callable[[], DataFrame],
    keys: Sequence[str] | None = None,
    exclude_buckets: Sequence[str] = (),
    as_of: str | datetime | None = None,
) -> Source:
    """Queries over a point table, given as steps."""
    return partial(_load_series, table, keys, exclude_buckets, as_of)


def _ranged_tables(spark: SparkSession, text: str, params: Mapping, time: str) -> dict[str, str]:
    """Tables and views that a query names and that have the time column, with that column's type."""
    words = set(re.findall(r"\w+", text.lower())) | {str(v).lower() for v in params.values()}
    found = {}
    for name in sorted({t.name for t in spark.catalog.listTables() if t.name.lower() in words}):
        kinds = {f.name: f.dataType for f in spark.table(name).schema}
        if time in kinds:
            found[name] = kinds[time].simpleString()
    return found


def _under_range(text: str, tables: Mapping[str, str], time: str, params: Mapping) -> str:
    """The query over tables cut to a range: each named table is shadowed by a query of the same name in front."""
    bounds = [(op, name) for op, name in ((">=", "range_start"), ("<", "range_stop")) if name in params]
    conditions = {t: " AND ".join(f"`{time}` {op} CAST({{{name}}} AS {kind})" for op, name in bounds) for t, kind in tables.items()}
    cut = ", ".join(f"`{t}` AS (SELECT * FROM `{t}` WHERE {condition})" for t, condition in conditions.items())
    own = re.match(r"\s*with\s+", text, re.IGNORECASE)
    return f"WITH {cut}, {text[own.end():]}" if own else f"WITH {cut} {text}"


def _load_sql(time, spark, query, params, start, stop) -> DataFrame:
    if isinstance(query, Mapping):
        query, params = query["sql"], {**query["params"], **params}
    if start is None and stop is None:
        return run_sql(spark, query, params)
    text = query if isinstance(query, str) else "\n".join(query)
    tables = _ranged_tables(spark, text, params, time or TIME)
    if tables:
        bounds = {n: parse_instant(v).isoformat(sep=" ") for n, v in (("range_start", start), ("range_stop", stop)) if v is not None}
        return run_sql(spark, _under_range(text, tables, time or TIME, bounds), {**params, **bounds})
    if re.search(r"\b(limit|offset|tablesample)\b", text, re.IGNORECASE):
        raise ValueError(f"no table of the query has the time column {time or TIME!r}, and a range cannot follow its limit")
    df = run_sql(spark, query, params)
    return time_range(df, start, stop, time=_time_of(df, time))


def _time_of(df: DataFrame, time: str | None) -> str:
    """The column a range applies to: the named one, or the frame's own time column."""
    if time is None and TIME in df.columns:
        return TIME
    if time is None:
        raise ValueError(f"a range needs a time column; name one of {df.columns} for the source")
    return time


def sql_source(time: str | None = None) -> Source:
    """SQL over registered tables and views.

    A new range cuts every table the query names that has the time column (``TIME`` if none is named), before the query's own
    conditions, groups and limits. If none has it, the range applies to the result's time column, and a query with a limit raises.
    """
    return partial(_load_sql, time)


def _load_files(folders, time, spark, query, params, start, stop) -> DataFrame | None:
    df = read_local(spark, folders, query)
    if df is None or (start is None and stop is None):
        return df
    return time_range(df, start, stop, time=_time_of(df, time))


def file_source(folders: Sequence[str], time: str | None = None) -> Source:
    """Files by name, looked up in every folder. A new range applies to the named time column; without one it raises."""
    return partial(_load_files, list(folders), time)


def load_sources(
    spark: SparkSession, entry: Mapping, sources: Mapping[str, Source], start=None, stop=None
) -> dict[str, DataFrame]:
    """The frame of every data source of a plan entry, with the parameters of its first step."""
    frames = {}
    for name, query in filled_sources(entry).items():
        if name not in sources:
            raise ValueError(f"no source {name!r}; available: {sorted(sources)}")
        frame = sources[name](spark, query, {}, start, stop)
        if frame is not None:
            frames[name] = frame
    return frames


def run_plan(spark: SparkSession, entry: Mapping, sources: Mapping[str, Source], start=None, stop=None) -> DataFrame:
    """All data of a plan entry as one frame, over another time range if one is given."""
    return fuse(load_sources(spark, entry, sources, start, stop).values())
