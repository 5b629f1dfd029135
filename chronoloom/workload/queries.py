"""Every registered query: a function of a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions import timefn
from chronoloom.functions.text import is_identifier
from chronoloom.operators import analytics, order, profile, select
from chronoloom.operators.fill import difference, fill_limited, fill_previous, with_lags
from chronoloom.operators.fuse import fuse, union_buckets
from chronoloom.operators.quantiles import ranks
from chronoloom.operators.reshape import pivot_last, plot_series, wide_to_points
from chronoloom.operators.runs import condition_runs
from chronoloom.operators.slots import Depth
from chronoloom.operators.sync import complete_grid, missing_report, on_grid, synchronise
from chronoloom.operators.window_agg import aggregate_window
from chronoloom.plans.models import GroupModels, GroupRegression
from chronoloom.plans.pipes import fit_pipe, fit_plans, fit_predict, load_pipe, predict_range, save_pipe
from chronoloom.plans.plan import file_source, run_plan, series_source, sql_source
from chronoloom.plans.query import run_query
from chronoloom.plans.stages import (
    Centre,
    CentreModel,
    LagFeatures,
    Synchronise,
    predict_groups,
    predict_rows_per_bucket,
    slot_of,
    sufficient_statistics,
)
from chronoloom.schema import BUCKET, FIELD, MEASUREMENT, TIME, VALUE, parse_instant
from chronoloom.session import scratch_path, use_utc
from chronoloom.sources import annotated, catalogue, files, relational, series_table
from chronoloom.sources.generate import clock, sensor_rows
from chronoloom.streaming.fill import disk_state, stream_filled
from chronoloom.streaming.learn import latest_model, predict_and_partial_fit, predictions
from chronoloom.streaming.points import read_stream, run_available, stream_grid, stream_windows, streamed_table
from chronoloom.workload.tables import FIELDS, SERIES, TAGS, as_points, points, table

Query = Callable[[SparkSession, str], DataFrame]

# The whole span of the event table.
START, STOP = "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z"
# A three-day range inside it, for queries about ranges.
RANGE = {"start": "2024-01-10T00:00:00Z", "stop": "2024-01-13T00:00:00Z"}
# Readings below this count as missing where a query needs gaps.
DETECTION = 5.0
DELAY = "10m"
# Starts of the batches in which events arrive; the first is open.
WEEKS = [None, "2024-01-08 00:10:00", "2024-01-15 12:00:00", "2024-01-22 00:00:00"]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose small readings are missing."""
    return points(spark, sf_dir).withColumn(VALUE, F.when(F.col(VALUE) >= DETECTION, F.col(VALUE)))


# --- synchronisation


@query
def sync_5min(spark, sf_dir):
    return rounded(synchronise(points(spark, sf_dir), FIELDS), FIELDS)


@query
def sync_5min_series_scope(spark, sf_dir):
    return rounded(synchronise(points(spark, sf_dir), ["click", "view"], fill_scope="series"), ["click", "view"])


@query
def sync_nulls_dups(spark, sf_dir):
    """Missing readings, several readings at one instant, and grid times that tie in rounding."""
    coarse = gappy(spark, sf_dir).withColumn(
        TIME, timefn.from_epoch_seconds(timefn.floor_seconds(timefn.epoch_seconds(F.col(TIME)), "10m"), "timestamp_ntz")
    )
    return rounded(synchronise(coarse, FIELDS, [BUCKET, "floor"], step="1h", split="1d"), FIELDS)


@query
def sync_float32(spark, sf_dir):
    return rounded(synchronise(points(spark, sf_dir), FIELDS, float32=True), FIELDS, 3)


@query
def sync_grid(spark, sf_dir):
    return rounded(on_grid(points(spark, sf_dir), FIELDS), FIELDS)


@query
def sync_missing_report(spark, sf_dir):
    """Row and null counts before and after the fill."""
    grid = on_grid(points(spark, sf_dir), FIELDS)
    filled = fill_limited(grid, ["system_id"], [TIME, "floor", "equipment_number"], FIELDS, 2, "1h")
    before = missing_report(grid, FIELDS).withColumn("stage", F.lit("before"))
    after = missing_report(filled, FIELDS).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


@query
def narrow_wrap(spark, sf_dir):
    return synchronise(points(spark, sf_dir), FIELDS, narrow="wrap", temperatures=())


@query
def narrow_try(spark, sf_dir):
    out = synchronise(points(spark, sf_dir), FIELDS, narrow="try", temperatures=("view",))
    return rounded(out.withColumn("view", F.col("view").cast("double")), ["view"], 3)


# --- selection


@query
def range_half_open(spark, sf_dir):
    return select.time_range(points(spark, sf_dir), **RANGE)


@query
def range_open_ended(spark, sf_dir):
    return select.time_range(points(spark, sf_dir), "-48h", as_of=parse_instant(STOP))


@query
def range_epoch_seconds(spark, sf_dir):
    return select.time_range(points(spark, sf_dir), 1704844800, 1705104000)


SAVED = [
    {"bucket": ["b1", "b2"]},
    {"range": {"start": 0, "stop": 1}},
    {"filter_measurement": {"measurement": "action"}},
]


@query
def rerange_plan(spark, sf_dir):
    return run_query(points(spark, sf_dir), SAVED, RANGE["start"], RANGE["stop"])


@query
def filter_measurement(spark, sf_dir):
    return run_query(points(spark, sf_dir), {"filter_measurement": {"measurement": "traffic"}})


@query
def filter_not_measurement(spark, sf_dir):
    return run_query(points(spark, sf_dir), {"filter_not_measurement": {"measurement": "traffic"}})


@query
def filter_fields_or(spark, sf_dir):
    return run_query(points(spark, sf_dir), {"filter_field": [{"field": "click"}, {"field": "error"}]})


@query
def filter_any_of(spark, sf_dir):
    df = points(spark, sf_dir)
    return select.any_of(df, F.col(FIELD) == "signup", F.col("floor") == "2")


@query
def filter_not_field(spark, sf_dir):
    return run_query(points(spark, sf_dir), {"filter_not_field": [{"field": "click"}, {"field": "error"}]})


@query
def tag_filters(spark, sf_dir):
    steps = {
        "filter_system_id": {"system_id": ["1", "4", "7"]},
        "tag_is": [{"tag_name": "floor", "tag_value": "1"}, {"tag_name": "floor", "tag_value": "2"}],
        "tag_is_not": {"tag_name": "equipment_number", "tag_value": "14"},
    }
    return run_query(points(spark, sf_dir), steps)


@query
def element_and_type_filters(spark, sf_dir):
    tagged = points(spark, sf_dir).withColumns({"element": F.col(MEASUREMENT), "type": F.col("floor")})
    return run_query(tagged, {"filter_element": {"element": "traffic"}, "filter_type": {"type": "0"}})


@query
def value_between_incl(spark, sf_dir):
    step = {"bewteen_values_included_filter": {"min_value": 10, "max_value": 40}}
    return run_query(points(spark, sf_dir), step)


@query
def value_between_excl(spark, sf_dir):
    step = {"bewteen_values_not_included_filter": {"min_value": 10, "max_value": 40}}
    return run_query(points(spark, sf_dir), step)


@query
def contains_set(spark, sf_dir):
    step = {"contains": {"tag_name": "equipment_number", "set": ["3", "5", "8", "13", "21"]}}
    return run_query(points(spark, sf_dir), step)


@query
def contains_semi(spark, sf_dir):
    large_parts = table(spark, sf_dir, "part").where("p_size > 25").select("p_partkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return select.contains(lines, "l_partkey", large_parts)


@query
def keep_columns(spark, sf_dir):
    step = {"keep_columns": {"columns": [TIME, BUCKET, FIELD, VALUE]}}
    return run_query(points(spark, sf_dir), step)


@query
def drop_columns(spark, sf_dir):
    return run_query(points(spark, sf_dir), {"drop_columns": {"columns": TAGS}})


@query
def bucket_tag(spark, sf_dir):
    return select.with_bucket(points(spark, sf_dir).drop(BUCKET), "site")


@query
def union_of_buckets(spark, sf_dir):
    df = points(spark, sf_dir)
    parts = {name: df.where(F.col(BUCKET) == name).drop(BUCKET) for name in ("b0", "b2", "b3")}
    return union_buckets(parts)


@query
def bucket_discovery(spark, sf_dir):
    df = points(spark, sf_dir)
    internal = df.where(F.col("floor") == "0").withColumn(BUCKET, F.concat(F.lit("_"), F.col(BUCKET)))
    return select.bucket_names(df.unionByName(internal), exclude=["b3"])


@query
def bucket_exclusion_table(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    excluded = nations.select(F.concat(F.lit("b"), (F.col("n_nationkey") % 2).cast("string")).alias(BUCKET))
    return select.bucket_names(points(spark, sf_dir), excluded)


@query
def all_buckets_query(spark, sf_dir):
    steps = [{"buckets": ["all"]}, {"filter_field": {"field": "purchase"}}]
    return run_query(points(spark, sf_dir), steps, exclude_buckets=["b1"])


@query
def field_keys(spark, sf_dir):
    return select.field_keys(points(spark, sf_dir), as_of=STOP)


@query
def sql_params(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    lines = ["SELECT * FROM {table}", "WHERE {filter_field} > {filter_value}", "ORDER BY o_orderkey", "LIMIT {limit}"]
    params = {"table": "orders", "filter_field": "o_totalprice", "filter_value": 500.0, "limit": 100}
    return relational.run_sql(spark, lines, params)


@query
def sql_text(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    text = "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"
    return relational.run_sql(spark, text)


@query
def sql_rerange(spark, sf_dir):
    """A saved SQL query over another range of its time column."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    load = sql_source(time="o_orderdate")
    text = "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders"
    return load(spark, text, {}, "1997-01-01T00:00:00Z", "1998-01-01T00:00:00Z")


@query
def sql_rerange_limit(spark, sf_dir):
    """A saved query with its own order and limit over another range: the first rows of that range."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    lines = ["SELECT o_orderkey, o_orderdate, o_totalprice FROM {table}", "WHERE {filter_field} > {filter_value}", "ORDER BY o_orderkey", "LIMIT {limit}"]
    saved = {"sql": lines, "params": {"table": "orders", "filter_field": "o_totalprice", "filter_value": 500.0, "limit": 100}}
    return sql_source(time="o_orderdate")(spark, saved, {}, "1997-01-01T00:00:00Z", "1998-01-01T00:00:00Z")


@query
def rerange_stop_only(spark, sf_dir):
    """A saved query without a range, and one with, up to another end; readings before 1970 stay."""
    early = F.when(F.col("floor") == "0", F.expr("_time - INTERVAL 60 YEARS")).otherwise(F.col(TIME))
    df = points(spark, sf_dir).withColumn(TIME, early)
    plain = run_query(df, [{"bucket": ["b1"]}, {"filter_measurement": {"measurement": "action"}}], stop=RANGE["stop"])
    ranged = run_query(df, SAVED, RANGE["start"], RANGE["stop"])
    return plain.withColumn("saved", F.lit("none")).unionByName(ranged.withColumn("saved", F.lit("both")))


@query
def rows_above_value(spark, sf_dir):
    return relational.rows_above(table(spark, sf_dir, "customer"), "c_acctbal", 5000.0, 100, ["c_custkey"])


# --- windows, pivots, fills


@query
def agg_window_mean_15m(spark, sf_dir):
    return rounded(aggregate_window(points(spark, sf_dir), "15m", "mean", SERIES), [VALUE])


@query
def agg_window_max_30m_empty(spark, sf_dir):
    keys = [BUCKET, FIELD, "system_id"]
    return aggregate_window(points(spark, sf_dir), "30m", "max", keys, True, START, STOP)


@query
def agg_window_clipped(spark, sf_dir):
    """Bounds that are not multiples of the window: short first and last windows."""
    start, stop = "2024-01-05T10:20:00Z", "2024-01-08T07:45:00Z"
    df = select.time_range(points(spark, sf_dir), start, stop)
    return aggregate_window(df, "1h", ["count", "max"], [BUCKET, FIELD], True, start, stop)


@query
def agg_window_fns(spark, sf_dir):
    functions = ["mean", "max", "min", "sum", "count", "stddev", "spread", "first", "last"]
    df = aggregate_window(points(spark, sf_dir), "6h", functions, [BUCKET, FIELD])
    return rounded(df, ["mean", "sum", "stddev", "spread"])


@query
def agg_window_median(spark, sf_dir):
    df = aggregate_window(points(spark, sf_dir), "1d", "median", [BUCKET, FIELD])
    return rounded(df, [VALUE])


@query
def agg_window_pivot(spark, sf_dir):
    steps = {
        "range": {"start": START, "stop": STOP},
        "keep_columns": {"columns": [TIME, BUCKET, FIELD, VALUE]},
        "window_aggregation": {
            "every": "1h",
            "function": "mean",
            "create_empty": "false",
            "rowKey": [BUCKET, TIME],
            "columnKey": [FIELD],
            "valueColumn": VALUE,
            "fields": FIELDS,
        },
    }
    return rounded(run_query(points(spark, sf_dir), steps), FIELDS)


@query
def pivot_fields(spark, sf_dir):
    return pivot_last(points(spark, sf_dir), [TIME, BUCKET, "equipment_number"], FIELDS)


@query
def group_keys(spark, sf_dir):
    steps = {
        "range": {"start": START, "stop": STOP},
        "group": {"columns": [BUCKET]},
        "window_aggregation": {"every": "1h", "function": "sum", "create_empty": "false"},
        "difference": {"non_negative": "false"},
    }
    return rounded(run_query(points(spark, sf_dir), steps), [VALUE])


@query
def fill_previous_values(spark, sf_dir):
    return fill_previous(gappy(spark, sf_dir), [BUCKET, FIELD, "system_id"], split="1h", order=[TIME, "equipment_number"])


@query
def fill_limited_both_ways(spark, sf_dir):
    return fill_limited(gappy(spark, sf_dir), [BUCKET], [TIME, FIELD, "equipment_number"], [VALUE], 2, "1h")


@query
def fill_by_counts(spark, sf_dir):
    """The same fill in slots of about equally many rows."""
    return fill_limited(gappy(spark, sf_dir), [BUCKET], [TIME, FIELD, "equipment_number"], [VALUE], 2, Depth(2000, "1d"))


@query
def lags_by_counts(spark, sf_dir):
    """Earlier readings as features of raw points, in slots of about equally many rows."""
    lags = {"lag_1": 1, "lag_3": 3}
    return with_lags(points(spark, sf_dir), [BUCKET, FIELD], VALUE, lags, [TIME, "equipment_number"], "1000 rows by 6h")


@query
def difference_signed(spark, sf_dir):
    return rounded(difference(points(spark, sf_dir), SERIES, split="1d"), [VALUE])


@query
def difference_nonneg(spark, sf_dir):
    df = difference(gappy(spark, sf_dir), [BUCKET, FIELD], order=[TIME, "equipment_number"], non_negative=True, split="1h")
    return rounded(df, [VALUE])


@query
def sorted_points(spark, sf_dir):
    steps = {"keep_columns": {"columns": [TIME, BUCKET, FIELD, VALUE]}, "sort": {"columns": [VALUE, TIME]}}
    return run_query(points(spark, sf_dir), steps)


@query
def preview_rows(spark, sf_dir):
    return order.limit(table(spark, sf_dir, "customer"), 5, ["c_custkey"])


@query
def numbered_points(spark, sf_dir):
    """Every row's place in the order of value, then time and keys."""
    return order.numbered(points(spark, sf_dir), [VALUE, TIME, *SERIES], "place")


# --- composite queries

METER_PLAN = {
    "bucket": {"bucket": ["b0", "b1", "b2"]},
    "range": {"start": START, "stop": STOP},
    "filter_field": [{"field": "purchase"}],
    "tag_is": [{"tag_name": MEASUREMENT, "tag_value": "action"}],
    "window_aggregation": {"every": "30m", "function": "max", "create_empty": "true"},
    "fill": {"columns": VALUE, "previous": "true"},
    "difference": {"non_negative": "true"},
}


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_query(points(spark, sf_dir), METER_PLAN)


@query
def meter_consumption(spark, sf_dir):
    out = meters(spark, sf_dir).select(TIME, BUCKET, "floor", "equipment_number", VALUE)
    return rounded(out, [VALUE])


REACH_PLAN = [
    {"buckets": ["b0"]},
    {"range": {"start": START, "stop": STOP}},
    {"tag_is": {"tag_name": MEASUREMENT, "tag_value": "traffic"}},
    {"filter_field": [{"field": "click"}, {"field": "view"}]},
    {"tag_is": [{"tag_name": "floor", "tag_value": "0"}, {"tag_name": "floor", "tag_value": "1"}]},
    {"bewteen_values_included_filter": {"min_value": 10, "max_value": 40}},
    {"window_aggregation": {"every": "15m", "function": "mean", "create_empty": "false"}},
]


@query
def temperature_reach_input(spark, sf_dir):
    return rounded(run_query(points(spark, sf_dir), REACH_PLAN), [VALUE])


@query
def comfort_input(spark, sf_dir):
    steps = {
        "bucket": {"bucket": ["b0", "b1", "b3"]},
        "range": {"start": "2024-01-09T00:00:00.343Z", "stop": "2024-01-24T23:48:32.343Z"},
        "filter_measurement": {"measurement": "action"},
        "filter_field": [{"field": "error"}, {"field": "purchase"}, {"field": "signup"}],
        "tag_is": [{"tag_name": "floor", "tag_value": "1"}],
    }
    return run_query(points(spark, sf_dir), steps)


def _demo_plan() -> dict:
    return {
        "steps": {
            "Fuse": {
                "relational": {"table": "orders", "filter_field": "o_totalprice", "filter_value": 500.0, "limit": 100}
            },
            "Centre": {"inputCol": VALUE},
        },
        "data_sources": {
            "series": {
                "buckets": ["all"],
                "range": dict(RANGE),
                "filter_measurement": {"measurement": "action"},
                "filter_field": [{"field": "purchase"}, {"field": "signup"}],
            },
            "relational": [
                "SELECT * FROM {table}",
                "WHERE {filter_field} > {filter_value}",
                "ORDER BY o_orderkey",
                "LIMIT {limit}",
            ],
            "local": ["suppliers.csv", "absent.csv"],
        },
    }


def _demo_sources(spark: SparkSession, sf_dir: str) -> dict:
    folder = scratch_path(spark, "training-files")
    files.write_csv(table(spark, sf_dir, "supplier"), f"{folder}/suppliers.csv")
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return {
        "series": series_source(points(spark, sf_dir)),
        "relational": sql_source(),
        "local": file_source([folder]),
    }


@query
def demo_fused(spark, sf_dir):
    return run_plan(spark, _demo_plan(), _demo_sources(spark, sf_dir))


@query
def fuse_sources(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return fuse([orders, table(spark, sf_dir, "customer")])


@query
def fuse_type_conflict(spark, sf_dir):
    """A code that is text in one source and a number in the other, an amount of two widths."""
    names = ["key", "code", "amount"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_nationkey").alias("level"))
    return fuse([orders.toDF(*names), customers.toDF(*names)])


@query
def wide_to_long(spark, sf_dir):
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    fields = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return wide_to_points(table(spark, sf_dir, "lineitem"), ids, fields)


@query
def plot_lines(spark, sf_dir):
    wide = pivot_last(points(spark, sf_dir), [BUCKET, TIME], FIELDS)
    return plot_series(wide, FIELDS)


# --- profiles and result views


def _lines_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumns({c: F.when(F.col(c) != 0, F.col(c)) for c in ("l_discount", "l_tax")})


@query
def profile_lineitem(spark, sf_dir):
    lines = _lines_with_gaps(spark, sf_dir)
    return profile.profile_columns(lines, exact=lines.columns)


@query
def distinct_values(spark, sf_dir):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return profile.column_values(table(spark, sf_dir, "lineitem"), columns)


@query
def describe_numeric(spark, sf_dir):
    out = profile.describe(_lines_with_gaps(spark, sf_dir))
    return rounded(out, ["mean", "std", "min", "q25", "q50", "q75", "max"])


@query
def rows_with_gaps(spark, sf_dir):
    return select.rows_with_missing(_lines_with_gaps(spark, sf_dir))


@query
def complete_rows(spark, sf_dir):
    return select.complete_rows(_lines_with_gaps(spark, sf_dir).drop("l_shipdate"))


@query
def row_counts(spark, sf_dir):
    return points(spark, sf_dir).groupBy(BUCKET, MEASUREMENT).agg(F.count(F.lit(1)).alias("n"))


@query
def result_view(spark, sf_dir):
    """What a result page shows of an analysis: types and description of its columns, and its rows with gaps."""
    hours = aggregate_window(points(spark, sf_dir), "1h", "mean", [BUCKET, FIELD])
    views = profile.result_views(pivot_last(hours, [BUCKET, TIME], FIELDS, FIELD, VALUE))
    gaps = views["missing"].agg(F.lit("incomplete rows").alias("column"), F.count(F.lit(1)).alias("count"))
    out = views["dtypes"].join(views["description"], "column", "left").unionByName(gaps, allowMissingColumns=True)
    return rounded(out, ["mean", "std", "min", "q25", "q50", "q75", "max"], 5)


@query
def sql_types(spark, sf_dir):
    """The column types a table would be written with, and how many values each column would hold."""
    orders = table(spark, sf_dir, "orders")
    kinds = spark.createDataFrame([(f.name, relational.sql_type(f.dataType)) for f in orders.schema], "column string, sql_type string")
    return kinds.join(profile.profile_columns(orders).select("column", "n_rows", "n_nulls"), "column")


@query
def identifiers(spark, sf_dir):
    """Names that could be table names."""
    parts = table(spark, sf_dir, "part").select(F.explode(F.array("p_name", "p_brand", "p_type", F.regexp_replace("p_type", " ", "_"))).alias("name"))
    return parts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).withColumn("valid", is_identifier(F.col("name")))


@query
def clock_coverage(spark, sf_dir):
    """A clock of half hours, with the events of each."""
    ticks = clock(spark, START, STOP, 30)
    ends = timefn.from_epoch_seconds(timefn.floor_seconds(timefn.epoch_seconds(F.col("ts")), "30m"), "timestamp")
    counts = table(spark, sf_dir, "events").groupBy(ends.alias(TIME)).agg(F.count(F.lit(1)).alias("n"))
    out = ticks.join(counts, TIME, "left").fillna(0, subset=["n"])
    return out.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


# --- analytics


@query
def data_quality(spark, sf_dir):
    keys = [BUCKET, FIELD, "system_id"]
    out = analytics.data_quality(points(spark, sf_dir), keys, START, STOP, "6h")
    return rounded(out, ["max_gap_seconds"])


@query
def data_quality_narrow_range(spark, sf_dir):
    """Bounds narrower than the data, in which many series have no point."""
    keys = [BUCKET, FIELD, "equipment_number"]
    out = analytics.data_quality(points(spark, sf_dir), keys, RANGE["start"], RANGE["stop"], "6h")
    return rounded(out, ["max_gap_seconds"])


def regular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of each bucket at instants of a regular step, another for each; several readings at an instant are one mean."""
    steps = F.element_at(F.create_map(*[F.lit(x) for pair in {"b0": 300, "b1": 900, "b2": 3600, "b3": 7200}.items() for x in pair]), F.col(BUCKET))
    seconds = timefn.epoch_seconds(F.col(TIME))
    at = timefn.from_epoch_seconds(seconds - F.pmod(seconds, steps), "timestamp_ntz")
    return points(spark, sf_dir).groupBy(BUCKET, FIELD, at.alias(TIME)).agg(F.avg(VALUE).alias(VALUE))


@query
def nominal_interval(spark, sf_dir):
    """The interval at which each series usually reports."""
    out = analytics.nominal_intervals(regular(spark, sf_dir), [BUCKET, FIELD], "1m")
    return rounded(out, ["share"])


@query
def interval_drift(spark, sf_dir):
    """Weeks in which a series reports at another interval than usual."""
    return analytics.interval_drift(regular(spark, sf_dir), [BUCKET, FIELD], "7d", "1m")


@query
def data_quality_inferred(spark, sf_dir):
    """Data quality against each series' own usual interval."""
    out = analytics.data_quality(regular(spark, sf_dir), [BUCKET, FIELD], START, STOP, unit="1m")
    return rounded(out, ["max_gap_seconds"])


@query
def value_runs(spark, sf_dir):
    """Readings in a row above a value, runs over several days among them."""
    df = points(spark, sf_dir)
    return condition_runs(df, [BUCKET, FIELD], F.col(VALUE) >= DETECTION, [TIME, "equipment_number"], "1d")


@query
def value_runs_by_counts(spark, sf_dir):
    """The same of short runs, in slots of about equally many rows."""
    df = points(spark, sf_dir)
    return condition_runs(df, [BUCKET], F.col(VALUE) < DETECTION, [TIME, FIELD, "equipment_number"], "500 rows by 6h")


@query
def lasting_reach(spark, sf_dir):
    """From when on a zone stays near its setpoint for two hours."""
    windows = aggregate_window(points(spark, sf_dir), "30m", "mean", [BUCKET, FIELD])
    out = analytics.first_lasting_reach(windows, [BUCKET], "view", "click", "Europe/Madrid", "1h", tolerance=20.0)
    return out.withColumn("reached", F.col("reached").cast("timestamp_ntz"))


@query
def moving_outliers(spark, sf_dir):
    """Readings far from the median of the last ones of their series."""
    out = analytics.moving_outliers(points(spark, sf_dir), [BUCKET, FIELD], 11, 6.0, [TIME, "equipment_number"], "1d")
    return rounded(out, ["median", "spread"])


@query
def agg_window_empty_unfiltered(spark, sf_dir):
    """Empty windows in bounds narrower than the data, which is not filtered beforehand."""
    out = aggregate_window(points(spark, sf_dir), "6h", "max", [BUCKET, FIELD], True, RANGE["start"], RANGE["stop"])
    return rounded(out, [VALUE])


@query
def centre_large_offset(spark, sf_dir):
    """Deviations of readings near a thousand million, learned in two parts."""
    df = points(spark, sf_dir).withColumn(VALUE, F.col(VALUE) + 1e9)
    first = Centre(inputCol=VALUE, keys=[BUCKET]).fit(df.where("_time < '2024-01-15'"))
    learned = first.partial_fit(df.where("_time >= '2024-01-15'")).results(df)["learned"]
    return rounded(learned.withColumn("mean", F.col("mean") - 1e9).drop("m2"), ["mean", "std"], 3)


@query
def consumption_daily(spark, sf_dir):
    out = analytics.consumption_per_day(meters(spark, sf_dir), [BUCKET, "floor", "equipment_number"])
    return rounded(out, ["consumption"])


@query
def temperature_reach(spark, sf_dir):
    keys = [BUCKET, "floor"]
    windows = aggregate_window(points(spark, sf_dir), "15m", "mean", [*keys, FIELD])
    return analytics.temperature_reach(windows, keys, "view", "click", "Europe/Madrid", "15m", tolerance=5.0)


@query
def temperature_prediction(spark, sf_dir):
    """Predict a window mean from the one before it, by least squares over all series."""
    keys = [BUCKET, FIELD, "system_id"]
    windows = aggregate_window(points(spark, sf_dir), "1h", "mean", keys)
    lagged = LagFeatures(inputCol=VALUE, keys=keys, lags=[1])
    features = VectorAssembler(inputCols=lagged.names(), outputCol="features")
    regression = LinearRegression(featuresCol="features", labelCol=VALUE, solver="normal")
    model = Pipeline(stages=[lagged, features, regression]).fit(windows)
    out = model.transform(windows).select(*keys, TIME, VALUE, "prediction")
    return rounded(out, [VALUE, "prediction"], 4)


@query
def temperature_prediction_external(spark, sf_dir):
    """One field from its last window and another field, learned before a day and judged after it."""
    windows = aggregate_window(points(spark, sf_dir), "1h", "mean", [BUCKET, FIELD])
    wide = pivot_last(windows, [BUCKET, TIME], ["purchase", "view"], FIELD, VALUE).dropna()
    lagged = LagFeatures(inputCol="purchase", keys=[BUCKET], lags=[1])
    features = VectorAssembler(inputCols=[*lagged.names(), "view"], outputCol="features")
    regression = LinearRegression(featuresCol="features", labelCol="purchase", solver="normal")
    prepared = Pipeline(stages=[lagged, features]).fit(wide).transform(wide)
    model = regression.fit(prepared.where(f"{TIME} < '2024-01-21'"))
    out = model.transform(prepared.where(f"{TIME} >= '2024-01-21'")).select(BUCKET, TIME, "purchase", "prediction")
    return rounded(out, ["purchase", "prediction"], 4)


@query
def consumption_daily_local(spark, sf_dir):
    out = analytics.consumption_per_day(meters(spark, sf_dir), [BUCKET, "floor", "equipment_number"], "Europe/Madrid")
    return rounded(out, ["consumption"])


# --- stages


@query
def centre_per_bucket(spark, sf_dir):
    df = points(spark, sf_dir)
    out = Centre(inputCol=VALUE).fit(df).transform(df).select(*SERIES, TIME, "prediction", "residual", "score")
    return rounded(out, ["prediction", "residual", "score"])


@query
def pandas_model_per_bucket(spark, sf_dir):
    """A pandas model over learned features, one bucket's rows at a time."""
    df = points(spark, sf_dir)
    scored = Centre(inputCol=VALUE).fit(df).transform(df).select(BUCKET, FIELD, TIME, "equipment_number", "score")

    def predict(bucket, rows):
        rows["alarm"] = rows["score"].abs() > 2.0
        rows["label"] = bucket + "-" + rows[FIELD]
        return rows[["bucket", "_field", "_time", "equipment_number", "label", "alarm"]]

    schema = "bucket string, _field string, _time timestamp_ntz, equipment_number string, label string, alarm boolean"
    return predict_rows_per_bucket(scored, predict, schema)


@query
def pandas_model_whole_groups(spark, sf_dir):
    """Ranks over all rows of each bucket, counted by Spark, and pandas' ranks within a field, floor and day, which bound a group."""

    def ranked(key, rows):
        own = rows[[BUCKET, FIELD, TIME, "equipment_number"]]
        place = rows[VALUE].rank(method="min").astype("int64")
        return own.assign(rank=rows["rank"].astype("int64"), day_rank=place)

    schema = "bucket string, _field string, _time timestamp_ntz, equipment_number string, rank long, day_rank long"
    return predict_groups(ranks(points(spark, sf_dir), [BUCKET], VALUE, "rank"), ranked, schema, [BUCKET, FIELD, "floor", slot_of()])


@query
def demo_fit_predict(spark, sf_dir):
    """Fit on two sources with parameters, save, load, predict a later range of both."""
    table_points = points(spark, sf_dir)
    table_points.createOrReplaceTempView("all_points")
    plan = {
        "demo": {
            "steps": {"Fuse": {"series": {"site": "b0"}, "relational": {"site": "b2", "low": 1.0}}, "Centre": {"keys": [BUCKET]}},
            "data_sources": {
                "series": {"buckets": ["{site}"], "range": {"start": START, "stop": "2024-01-21T00:00:00Z"}},
                "relational": ["SELECT * FROM all_points", "WHERE bucket = '{site}' AND _value >= {low}"],
            },
        }
    }
    sources = {"series": series_source(table_points), "relational": sql_source()}
    path = scratch_path(spark, "demo")
    save_pipe(spark, fit_plans(spark, plan, sources)["demo"], path)
    out = predict_range(spark, load_pipe(spark, path), sources, "2024-01-21T00:00:00Z", STOP)
    return rounded(out.select(*SERIES, TIME, "prediction", "residual"), ["prediction", "residual"])


@query
def general_query(spark, sf_dir):
    """Buckets and range in one step."""
    steps = {"general_query": {"bucket": ["b1", "b3"], **RANGE}, "filter_field": [{"field": "view"}]}
    return run_query(points(spark, sf_dir), steps)


@query
def pipeline_save_load(spark, sf_dir):
    df = points(spark, sf_dir)
    path = scratch_path(spark, "pipe")
    save_pipe(spark, fit_pipe("centred", Pipeline(stages=[Centre(keys=[BUCKET, FIELD])]), df), path)
    out = load_pipe(spark, path).predict(df).select(*SERIES, TIME, "prediction", "residual")
    return rounded(out, ["prediction", "residual"])


@query
def plan_fit_predict(spark, sf_dir):
    """Fit a chain on one range of a plan's data, predict another range."""
    plan = {
        "centred": {
            "steps": {"Centre": {"keys": [BUCKET]}},
            "data_sources": {"series": {"buckets": ["all"], "range": {"start": START, "stop": "2024-01-21T00:00:00Z"}}},
        }
    }
    sources = {"series": series_source(points(spark, sf_dir))}
    pipe = fit_plans(spark, plan, sources)["centred"]
    out = predict_range(spark, pipe, sources, "2024-01-21T00:00:00Z", STOP)
    return rounded(out.select(*SERIES, TIME, "prediction", "residual"), ["prediction", "residual"])


@query
def stage_results(spark, sf_dir):
    """What a fitted stage reports beside its predictions."""
    df = points(spark, sf_dir)
    pipe = fit_pipe("centred", Pipeline(stages=[Centre(keys=[BUCKET, "system_id"])]), df)
    return rounded(pipe.results(df)[-1]["learned"], ["mean", "m2", "std"], 4)


@query
def updated_stage(spark, sf_dir):
    """A saved chain with a parameter changed afterwards."""
    df = points(spark, sf_dir)
    fields = ["purchase", "view"]
    pipe = fit_pipe("grid", Pipeline(stages=[Synchronise(fields=fields)]), df)
    pipe.update(fillLimit=1)
    return rounded(pipe.predict(df), fields)


@query
def synchronise_stage(spark, sf_dir):
    plan = {
        "grid": {
            "steps": {"Synchronise": {"fields": ["purchase", "view"]}, "Centre": {"inputCol": "view", "keys": ["floor"]}},
            "data_sources": {"series": [{"buckets": ["all"]}, {"range": {"start": START, "stop": STOP}}]},
        }
    }
    sources = {"series": series_source(points(spark, sf_dir))}
    pipe = fit_plans(spark, plan, sources)["grid"]
    out = pipe.predict(run_plan(spark, plan["grid"], sources))
    return rounded(out.drop("score"), ["purchase", "view", "prediction", "residual"])


@query
def model_per_series(spark, sf_dir):
    """A pandas model of each series, fitted on whole groups in one job, saved, loaded, applied slot by slot."""
    keys = [BUCKET, FIELD, "system_id"]
    windows = aggregate_window(points(spark, sf_dir), "1h", "mean", keys)
    stage = GroupModels(model="MedianBand", keys=keys, columns=[VALUE], slot="10 days")
    path = scratch_path(spark, "pipe")
    save_pipe(spark, fit_pipe("bands", Pipeline(stages=[stage]), windows), path)
    out = load_pipe(spark, path).predict(windows)
    return rounded(out, [VALUE, "prediction", "score"], 4)


def _lagged_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = aggregate_window(points(spark, sf_dir), "1h", "mean", [BUCKET, FIELD])
    return LagFeatures(inputCol=VALUE, keys=[BUCKET, FIELD], lags=[1, 24]).transform(windows)


@query
def regression_per_series(spark, sf_dir):
    """Least squares of each series on its last hour and the hour a day before, learned week by week."""
    rows, keys = _lagged_windows(spark, sf_dir), [BUCKET, FIELD]
    stage = GroupRegression(features=["lag_1", "lag_24"], keys=keys)
    model = stage.fit(rows.where(f"{TIME} < '2024-01-10'"))
    for low, high in (("2024-01-10", "2024-01-18"), ("2024-01-18", "2025-01-01")):
        model = model.partial_fit(rows.where(f"{TIME} >= '{low}' AND {TIME} < '{high}'"))
    slopes = [F.col("coefficients")[i].alias(name) for i, name in enumerate(("by_hour", "by_day"))]
    return rounded(model.learned().select(*keys, "n", "intercept", *slopes, "r2"), ["intercept", "by_hour", "by_day", "r2"], 5)


@query
def regression_predictions(spark, sf_dir):
    """Each hour predicted by the regression of its own series."""
    rows, keys = _lagged_windows(spark, sf_dir), [BUCKET, FIELD]
    model = GroupRegression(features=["lag_1", "lag_24"], keys=keys).fit(rows)
    return rounded(model.transform(rows).select(*keys, TIME, "prediction"), ["prediction"], 4)


@query
def probability_per_bucket(spark, sf_dir):
    """How probable a residual as large is, for every reading."""
    df = points(spark, sf_dir)
    pipe = fit_pipe("centred", Pipeline(stages=[Centre(keys=[BUCKET, FIELD])]), df)
    return rounded(pipe.predict_proba(df).select(*SERIES, TIME, "score", "probability"), ["score", "probability"], 5)


@query
def two_plans_one_empty(spark, sf_dir):
    """Two entries fitted side by side; the one without data is left out."""
    entry = lambda bucket: {
        "steps": {"Centre": {"keys": [FIELD]}},
        "data_sources": {"series": {"bucket": {"bucket": [bucket]}, "range": {"start": START, "stop": STOP}}},
    }
    sources = {"series": series_source(points(spark, sf_dir))}
    pipes = fit_plans(spark, {"full": entry("b1"), "empty": entry("b9")}, sources)
    learned = [pipe.results(points(spark, sf_dir))[-1]["learned"].withColumn("pipe", F.lit(name)) for name, pipe in sorted(pipes.items())]
    return rounded(fuse(learned).select("pipe", FIELD, "n", "mean", "std"), ["mean", "std"], 4)


@query
def fit_and_predict(spark, sf_dir):
    """Fitting and predicting the same rows in one call; the model lets go of what it holds before it predicts once more."""
    df = points(spark, sf_dir)
    pipe, first = fit_predict("centred", Pipeline(stages=[Centre(keys=[BUCKET])]), df)
    pipe.model.stages[-1].stats.persist()
    pipe.release()
    names = [*SERIES, TIME]
    again = pipe.predict(df).select(*names, F.col("residual").alias("again"))
    return rounded(first.select(*names, "prediction", "residual").join(again, names), ["prediction", "residual", "again"])


@query
def stage_matrices(spark, sf_dir):
    """What a fitted chain tells of itself: stage, its parameters, and the size of each of its results."""
    df = points(spark, sf_dir)
    pipe = fit_pipe("chain", Pipeline(stages=[Centre(keys=[BUCKET, FIELD])]), df)
    rows = []
    for uid, found in pipe.matrices(df).items():
        attributes, file = pipe.attributes()[uid], pipe.files()[uid].rsplit("/", 1)[-1]
        for name, (columns, count) in found.items():
            rows.append((pipe.info()[uid].split()[0], name, ",".join(columns), count, ",".join(attributes["keys"]), file))
    return spark.createDataFrame(rows, "stage string, result string, columns string, n_rows long, keys string, file string")


# --- time functions


@query
def rfc3339_text(spark, sf_dir):
    text = timefn.format_rfc3339(F.col("ts"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return events.withColumn("parsed", timefn.parse_rfc3339(F.col("text"), "timestamp_ntz"))


@query
def time_functions(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        timefn.epoch_seconds(ts).alias("seconds"),
        timefn.ceil_to(ts).alias("ceil_minute"),
        timefn.snap(ts).alias("grid"),
        timefn.plus(ts, "30m", 3).alias("later"),
        timefn.combine(ts, 7, 30).alias("morning"),
        timefn.local_time(ts, "Europe/Madrid").alias("local"),
        timefn.from_epoch_seconds(timefn.epoch_seconds(ts), "timestamp_ntz").alias("whole"),
    )


# --- sources and sinks


@query
def csv_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders") + ".csv"
    files.write_csv(orders, path)
    return files.read_any(spark, path, schema=orders.schema)


@query
def json_roundtrip(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer") + ".json"
    files.write_json(customers, path)
    return files.read_any(spark, path, schema=customers.schema)


@query
def json_mixed_layouts(spark, sf_dir):
    """JSON lines and files that hold one array each, of a thousand keys, read together."""
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customers")
    files.write_json(customers.where("c_nationkey <> 0"), f"{path}/lines.json")
    part = F.floor(F.col("c_custkey") / 1000).alias("part")
    arrays = customers.where("c_nationkey = 0").groupBy(part).agg(F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value"))
    arrays.write.partitionBy("part").text(f"{path}/array.json")
    return files.read_json(spark, [f"{path}/array.json", f"{path}/lines.json"], customers.schema)


@query
def json_prediction_input(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer") + ".json"
    files.write_json(customers, path)
    return files.read_for_prediction(spark, path).withColumn("c_nationkey", F.col("c_nationkey").cast("int")).select(customers.columns)


@query
def csv_awkward_text(spark, sf_dir):
    """Texts with line breaks, quotes and commas, empty ones and null."""
    key = F.col("o_orderkey") % 5
    text = F.when(key == 0, F.concat(F.col("o_orderpriority"), F.lit("\nnext")))
    text = text.when(key == 1, F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('", twice'))).when(key == 2, "").when(key == 3, F.col("o_orderpriority"))
    odd = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("note"))
    path = scratch_path(spark, "notes") + ".csv"
    files.write_csv(odd, path)
    return files.read_any(spark, path, schema=odd.schema)


@query
def parquet_prediction_input(spark, sf_dir):
    path = scratch_path(spark, "part") + ".parquet"
    files.write_parquet(table(spark, sf_dir, "part"), path)
    return files.read_for_prediction(spark, path)


@query
def csv_prediction_input(spark, sf_dir):
    """A prediction file must have a timestamp column."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("timestamp"), "value")
    path = scratch_path(spark, "prediction") + ".csv"
    files.write_csv(events, path)
    df = files.read_for_prediction(spark, path)
    return df.withColumns({"event_id": F.col("event_id").cast("long"), "timestamp": F.col("timestamp").cast("timestamp_ntz")})


@query
def points_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "points")
    series_table.write_points(points(spark, sf_dir), path)
    return series_table.scan_points(spark, path, ["b0", "b2"], **RANGE)


@query
def points_roundtrip_whole(spark, sf_dir):
    path = scratch_path(spark, "points")
    series_table.write_points(points(spark, sf_dir), path)
    return series_table.scan_points(spark, path)


@query
def catalogue_discovery(spark, sf_dir):
    """Series found in the catalogue of a table that grew by appends and had one bucket replaced; no point is read for it."""
    df, path = points(spark, sf_dir), scratch_path(spark, "points")
    series_table.write_points(df.where(f"{TIME} < '2024-01-12'"), path)
    catalogue.refresh_catalogue(spark, path)
    series_table.write_points(df.where(f"{TIME} >= '2024-01-12'"), path)
    catalogue.refresh_catalogue(spark, path)
    series_table.replace_buckets(df.where("bucket = 'b2' AND _field <> 'error'"), path)
    entries = catalogue.refresh_catalogue(spark, path)
    return catalogue.series_extent(entries).select(*SERIES, "first_time", "last_time", "n_rows")


@query
def catalogue_field_keys(spark, sf_dir):
    """Fields with a reading in the last days, from the catalogue."""
    path = scratch_path(spark, "points")
    series_table.write_points(points(spark, sf_dir).where(f"{FIELD} <> 'signup' OR {TIME} < '2024-01-20'"), path)
    found = catalogue.series_catalogue(spark, path)
    return catalogue.field_keys_of(found, "2024-01-29T06:30:00Z", 3, ["b0", "b3"])


@query
def upload_wide_rows(spark, sf_dir):
    """Wide rows of several measurements to long points of one bucket, and back."""
    events = table(spark, sf_dir, "events")
    wide = events.select(
        F.col("event_type").alias(MEASUREMENT),
        (F.col("user_id") % 3).cast("string").alias("floor"),
        F.col("ts").alias(TIME),
        F.col("value").alias("level"),
        F.col("user_id").alias("device"),
        F.col("props").alias("note"),
    )
    path = scratch_path(spark, "uploaded")
    series_table.upload_wide(wide, path, "site", ["floor"], ["level", "device", "note"])
    out = series_table.scan_points(spark, path, "site")
    return out.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


@query
def annotated_csv_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    wide = events.select(
        F.col("event_type").alias(MEASUREMENT),
        (F.col("user_id") % 4).cast("string").alias("zone"),
        (F.col("user_id") % 3).cast("string").alias("floor"),
        F.col("ts").alias(TIME),
        "value",
        "event_id",
        F.col("props").alias("note"),
        (F.col("value") > 100).alias("high"),
    )
    path = scratch_path(spark, "annotated")
    annotated.write_annotated_csv(wide, path, ["zone", "floor"], ["value", "event_id", "note", "high"])
    return annotated.read_annotated_csv(spark, path).withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


@query
def annotated_mixed_headers(spark, sf_dir):
    """A folder of annotated files of two layouts, each read by its own header."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias(MEASUREMENT), F.col("ts").alias(TIME), "value", "event_id", "user_id")
    path = scratch_path(spark, "annotated")
    annotated.write_annotated_csv(events.where("user_id % 2 = 0"), f"{path}/one", [], ["value", "event_id"])
    annotated.write_annotated_csv(events.where("user_id % 2 = 1"), f"{path}/two", [], ["event_id", "user_id"])
    return annotated.read_annotated_csv(spark, f"{path}/*").withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


@query
def generate_sensor_data(spark, sf_dir):
    """One synthetic row per event instant; values follow from the event's identity alone."""
    times = table(spark, sf_dir, "events").select(F.col("ts").alias(TIME), "event_id")
    return sensor_rows(times, F.col("event_id").cast("string"))


# --- streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    folder = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    if folder:
        return as_points(read_stream(spark, f"{sf_dir}/events.parquet", events.schema))
    return as_points(read_stream(spark, sf_dir, events.schema, glob="events.parquet"))


@query
def stream_window_max(spark, sf_dir):
    path = scratch_path(spark, "stream-windows")
    run_available(stream_windows(_event_stream(spark, sf_dir), "30m", "max", [BUCKET, FIELD], DELAY), path)
    return streamed_table(spark, path).withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


def _arriving(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The events in files of a week each, written week after week, and the number of files a week.

    As many as the tasks that Spark reads the events with, so that a large file is not dealt to two writers and two readers.
    """
    events = table(spark, sf_dir, "events")
    files_a_week = max(2, events.rdd.getNumPartitions())
    path = scratch_path(spark, "arriving")
    for low, high in zip(WEEKS, [*WEEKS[1:], None]):
        week = events.where(F.col("ts") >= F.lit(low)) if low else events
        week = week.where(F.col("ts") < F.lit(high)) if high else week
        week.repartition(files_a_week).write.mode("append").parquet(path)
    return path, files_a_week


def _weekly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream whose batches are weeks."""
    path, files_a_week = _arriving(spark, sf_dir)
    return as_points(read_stream(spark, path, table(spark, sf_dir, "events").schema, files_per_batch=files_a_week))


@query
def stream_window_max_batches(spark, sf_dir):
    """Windows of a stream that arrives in several batches, some windows in two of them."""
    path = scratch_path(spark, "stream-windows")
    run_available(stream_windows(_weekly_stream(spark, sf_dir), "30m", "max", [BUCKET, FIELD], DELAY), path)
    return streamed_table(spark, path).withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


@query
def partial_fit_predictions(spark, sf_dir):
    """Predictions of a model that learns from each batch after predicting it."""
    keys = [BUCKET, FIELD]
    start = CentreModel(sufficient_statistics(points(spark, sf_dir).limit(0), keys))
    start.update(keys=keys)
    path = scratch_path(spark, "stream-model")
    predict_and_partial_fit(_weekly_stream(spark, sf_dir), start, path, keep=2)
    shifted = (F.col("prediction") + 3e-8).alias("prediction")  # off the halves at which two roundings may part
    out = predictions(spark, path).select(*SERIES, F.col(TIME).cast("timestamp_ntz").alias(TIME), shifted)
    return rounded(out, ["prediction"])


@query
def stream_sync_grid(spark, sf_dir):
    path = scratch_path(spark, "stream-grid")
    run_available(stream_grid(_event_stream(spark, sf_dir), FIELDS, delay=DELAY), path)
    return rounded(streamed_table(spark, path), FIELDS)


@query
def stream_sync_filled(spark, sf_dir):
    """The streamed grid, its short gaps filled once its steps are closed."""
    path = scratch_path(spark, "stream-filled")
    run_available(stream_grid(_event_stream(spark, sf_dir), FIELDS, delay=DELAY), path)
    return rounded(complete_grid(streamed_table(spark, path), FIELDS), FIELDS)


@query
def stream_fill_batches(spark, sf_dir):
    """The grid of a stream filled as it closes, with the last rows of each system as state, over several batches."""
    path = scratch_path(spark, "stream-filled")
    with disk_state(spark):
        run_available(stream_filled(stream_grid(_weekly_stream(spark, sf_dir), FIELDS, delay=DELAY), FIELDS), path)
    return rounded(streamed_table(spark, path), FIELDS)


@query
def stream_fill_series(spark, sf_dir):
    """The same, each device filled from itself by one row at most."""
    path = scratch_path(spark, "stream-filled")
    fields = ["click", "view"]
    grid = stream_grid(_weekly_stream(spark, sf_dir), fields, delay=DELAY)
    with disk_state(spark):
        run_available(stream_filled(grid, fields, fill_scope="series", fill_limit=1), path)
    return rounded(streamed_table(spark, path), fields)


@query
def stream_grid_10m(spark, sf_dir):
    """A streamed grid of an even step, over several batches."""
    path = scratch_path(spark, "stream-grid")
    run_available(stream_grid(_weekly_stream(spark, sf_dir), FIELDS, step="10m", delay=DELAY), path)
    return rounded(streamed_table(spark, path), FIELDS)


@query
def partial_fit_stats(spark, sf_dir):
    """What a model has learned from the stream, batch by batch."""
    keys = [BUCKET, FIELD]
    empty = sufficient_statistics(points(spark, sf_dir).limit(0), keys)
    start = CentreModel(empty)
    start.update(keys=keys)
    path = scratch_path(spark, "stream-model")
    predict_and_partial_fit(_event_stream(spark, sf_dir), start, path)
    return rounded(latest_model(spark, start, path).stats, ["mean", "m2"], 4)
