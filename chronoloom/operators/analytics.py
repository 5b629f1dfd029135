"""Building analytics. The inputs are fixed by query plans; the measures are defined here."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.numeric import present
from chronoloom.functions.timefn import epoch_micros, local_time
from chronoloom.operators.fill import with_previous, with_recent
from chronoloom.operators.quantiles import quantiles_of, value_counts
from chronoloom.operators.reshape import pivot_last
from chronoloom.operators.runs import condition_runs, lasting
from chronoloom.operators.slots import Depth
from chronoloom.schema import FIELD, TIME, VALUE, duration_seconds, epoch_of, instant_literal, parse_instant, type_of

# Fixed value: fences lie this many interquartile ranges beyond the quartiles.
FENCE = 1.5


def _join_by(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null; the right side's keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def data_quality(
    points: DataFrame,
    keys: Sequence[str],
    start: str | datetime,
    stop: str | datetime,
    nominal: str | None = None,
    split: str | Depth | None = "1h",
    unit: str = "1s",
) -> DataFrame:
    """Per series: points, windows without a point, late gaps, values outside the quartile fences.

    Only points from ``start`` up to ``stop`` count; a series with points outside only has a row
    without any. Expected windows are those of width ``nominal`` between the bounds. A gap is more
    than ``nominal`` between neighbouring points, or between a bound and the point next to it.

    Without ``nominal`` each series has its own, the most frequent gap between its points in units of ``unit`` (``nominal_intervals``), which the result
    names as ``nominal_seconds``; a series without two different instants expects one point in the whole range.
    """
    first, last = parse_instant(start), parse_instant(stop)
    kind = type_of(points, TIME)
    inside = (F.col(TIME) >= instant_literal(first, kind)) & (F.col(TIME) < instant_literal(last, kind))
    counts = value_counts(points, keys, VALUE, inside)
    series = counts.select("k").distinct().select([F.col("k")[k].alias(k) for k in keys])
    fences = quantiles_of(counts, keys, {"__q1": 0.25, "__q3": 0.75}).select(F.struct(*keys).alias("k"), "__q1", "__q3")
    reach = (F.col("__q3") - F.col("__q1")) * FENCE
    outside = (F.col("v") < F.col("__q1") - reach) | (F.col("v") > F.col("__q3") + reach)
    outliers = counts.join(fences, "k").groupBy("k").agg(F.sum(F.when(outside, F.col("m")).otherwise(0)).alias("n_outliers"))
    outliers = outliers.select([F.col("k")[k].alias(k) for k in keys] + ["n_outliers"])

    clocked = points.where(inside).select(*keys, TIME, epoch_micros(F.col(TIME)).alias("__us"))
    low, high = (F.lit(int(epoch_of(t) * 1_000_000)) for t in (first, last))
    whole = (high - low) / F.lit(1e6)
    if nominal is None:
        usual = nominal_intervals(points.where(inside), keys, unit, split).select(*keys, "nominal_seconds")
        series = _join_by(series, usual, keys).withColumn("nominal_seconds", F.coalesce("nominal_seconds", F.ceil(whole).cast("long")))
        clocked = _join_by(clocked, series, keys, "inner")
        late, named = F.col("nominal_seconds"), ["nominal_seconds"]
    else:
        late, named = F.lit(duration_seconds(nominal)).cast("long"), []
    step = late * 1_000_000
    # As many windows as the bounds touch: from the floor of the one to the ceiling of the other.
    expected = F.floor((high - 1) / step) - F.floor(low / step) + 1
    paired = with_previous(clocked, keys, {"__us": "__before"}, [TIME], split)
    now, before = F.col("__us"), F.col("__before")
    apart = (now - F.coalesce(before, low)) / F.lit(1e6)
    tail = (high - F.max("__us")) / F.lit(1e6)
    # In time order a window is entered once, by the point whose predecessor lies in another one.
    enters = before.isNull() | (now - F.pmod(now, step) != before - F.pmod(before, step))
    timed = paired.groupBy(*keys, *named).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_if(enters).alias("n_windows"),
        F.count_if(apart > late).alias("n_late"),
        F.greatest(F.max(apart), tail).alias("max_gap_seconds"),
        tail.alias("tail"),
    )
    found = _join_by(_join_by(series, timed.drop(*named), keys), outliers, keys)
    return found.select(
        *keys,
        *named,
        F.coalesce("n_points", F.lit(0)).alias("n_points"),
        (expected - F.coalesce("n_windows", F.lit(0))).alias("n_missing_windows"),
        (F.coalesce("n_late", F.lit(0)) + F.when(F.coalesce("tail", whole) > late, 1).otherwise(0)).alias("n_gaps"),
        F.coalesce("max_gap_seconds", whole).alias("max_gap_seconds"),
        F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"),
    )


def nominal_intervals(points: DataFrame, keys: Sequence[str], unit: str = "1s", split: str | Depth | None = "1h") -> DataFrame:
    """Per series the interval at which it usually reports: keys, ``nominal_seconds``, ``n_gaps`` and the ``share`` of gaps of that length.

    Gaps between neighbouring points are rounded to ``unit`` and counted; the counts combine before the shuffle. The most frequent gap wins, the
    shorter of equally frequent ones. Points at one instant have no gap; a series without gaps has no row.
    """
    hist = _gap_counts(points, keys, unit, split)
    return hist.groupBy(*keys).agg(
        F.max_by("gap", F.struct(F.col("n"), -F.col("gap"))).alias("nominal_seconds"), F.sum("n").alias("n_gaps"), (F.max("n") / F.sum("n")).alias("share")
    )


def interval_drift(points: DataFrame, keys: Sequence[str], period: str = "1d", unit: str = "1s", split: str | Depth | None = "1h") -> DataFrame:
    """Periods in which a series reports at another interval than it usually does: keys, ``period`` (its start), ``nominal_seconds``, ``usual_seconds``."""
    at = F.window(TIME, f"{duration_seconds(period)} seconds")["start"].alias("period")
    hist = _gap_counts(points, keys, unit, split, [at])
    within = hist.groupBy(*keys, "period").agg(F.max_by("gap", F.struct(F.col("n"), -F.col("gap"))).alias("nominal_seconds"))
    whole = hist.groupBy(*keys, "gap").agg(F.sum("n").alias("n")).groupBy(*keys)
    usual = whole.agg(F.max_by("gap", F.struct(F.col("n"), -F.col("gap"))).alias("usual_seconds"))
    return _join_by(within, usual, keys, "inner").where("nominal_seconds <> usual_seconds")


def _gap_counts(points: DataFrame, keys: Sequence[str], unit: str, split, by: Sequence[Column] = ()) -> DataFrame:
    """How often each series has each gap, in seconds."""
    wide = duration_seconds(unit)
    clocked = points.select(*keys, TIME, epoch_micros(F.col(TIME)).alias("__us"))
    paired = with_previous(clocked, keys, {"__us": "__before"}, [TIME], split)
    gap = (F.round((F.col("__us") - F.col("__before")) / F.lit(wide * 1_000_000)) * wide).cast("long")
    return paired.withColumn("gap", gap).where("gap > 0").groupBy(*keys, *by, "gap").agg(F.count(F.lit(1)).alias("n"))


def moving_outliers(
    df: DataFrame,
    keys: Sequence[str],
    rows: int = 25,
    limit: float = 5.0,
    order: Sequence[str] = (TIME,),
    split: str | Depth | None = "1d",
    value: str = VALUE,
) -> DataFrame:
    """Rows with the ``median`` of the last ``rows`` values of their series, the row's own included, their median distance from it
    (``spread``), and whether the row lies more than ``limit`` spreads away (``outlier``).

    The median follows the series, so that after a step in level the new level counts as usual once half of the rows are of it. Missing
    values are passed over, and are no outliers; where all recent values are equal, any other value is one.
    """
    recent = with_recent(df.withColumn("__v", present(F.col(value).cast("double"))), keys, "__v", rows, "__recent", order, split)
    middle = recent.withColumn("median", median_of(F.col("__recent")))
    spread = median_of(F.transform("__recent", lambda x: F.abs(x - F.col("median"))))
    apart = F.abs(F.col("__v") - F.col("median"))
    return middle.withColumn("spread", spread).withColumn("outlier", F.coalesce(apart > F.lit(limit) * F.col("spread"), F.lit(False))).drop("__v", "__recent")


def median_of(values: Column) -> Column:
    """The median of an array without nulls; null if it is empty."""
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int")), F.try_element_at(ordered, F.floor((n + 2) / 2).cast("int"))
    return F.when(n > 0, low + (high - low) / 2)


def first_lasting_reach(
    windows: DataFrame, keys: Sequence[str], room: str, setpoint: str, zone: str, span: str, tolerance: float = 0.5, split: str | Depth = "1d"
) -> DataFrame:
    """Per key and local day the first time from which the room stays near its setpoint for ``span`` or longer: keys, ``day``, ``reached``, ``seconds``.

    ``windows`` holds window means of both fields; windows without one of them are passed over. A stay over midnight belongs to the day it begins on.
    """
    wide = pivot_last(windows, [*keys, TIME], [room, setpoint], FIELD, VALUE).dropna(subset=[room, setpoint])
    near = F.abs(F.col(room) - F.col(setpoint)) <= tolerance
    stays = lasting(condition_runs(wide, keys, near, [TIME], split), span).withColumn("day", F.to_date(local_time(F.col("start"), zone)))
    return stays.groupBy(*keys, "day").agg(F.min("start").alias("reached"), F.min_by("seconds", "start").alias("seconds"))


def consumption_per_day(meters: DataFrame, keys: Sequence[str], zone: str | None = None) -> DataFrame:
    """Consumption summed per key and day, from the output of a meter query; days of ``zone``, or of UTC.

    A window's time is its end, so the window that ends at midnight belongs to the day before.
    """
    end = F.col(TIME) if zone is None else local_time(F.col(TIME), zone)
    day = F.to_date(end - F.expr("interval 1 microsecond"))
    return meters.groupBy(*keys, day.alias("day")).agg(
        F.sum(VALUE).alias("consumption"), F.count(VALUE).alias("n_windows")
    )


def temperature_reach(
    windows: DataFrame,
    keys: Sequence[str],
    room: str,
    setpoint: str,
    zone: str,
    every: str,
    start_hour: int = 7,
    start_minute: int = 30,
    window_hours: int = 6,
    tolerance: float = 0.5,
) -> DataFrame:
    """Per key and local day: minutes from the start hour until the room is near its setpoint.

    ``windows`` holds window means of both fields, of windows as wide as ``every``; a window's time
    is its end, and minutes count to its start, so no reading before the start hour takes part. A
    day on which the setpoint is not reached within the window has a null; a day without both
    readings has no row.
    """
    wide = pivot_last(windows, [*keys, TIME], [room, setpoint], FIELD, VALUE).dropna(subset=[room, setpoint])
    begun = F.col(TIME) - F.make_interval(secs=F.lit(duration_seconds(every)))
    local = wide.withColumn("__local", local_time(begun, zone))
    minute = F.hour("__local") * 60 + F.minute("__local") - F.lit(start_hour * 60 + start_minute)
    inside = local.withColumns({"__minute": minute, "day": F.to_date("__local")}).where(
        (F.col("__minute") >= 0) & (F.col("__minute") < window_hours * 60)
    )
    near = F.abs(F.col(room) - F.col(setpoint)) <= tolerance
    return inside.groupBy(*keys, "day").agg(
        F.min(F.when(near, F.col("__minute"))).cast("long").alias("minutes_to_reach"),
        F.count(F.lit(1)).alias("n_windows"),
    )
