from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from chronoloom.operators import analytics
from chronoloom.operators.window_agg import AGGREGATES, aggregate_window, expected_windows

T0 = datetime(2025, 6, 1)
SCHEMA = "k string, _time timestamp, _value double"


def frame(spark, rows):
    return spark.createDataFrame([(k, T0 + timedelta(minutes=m), v) for k, m, v in rows], SCHEMA)


def shown(df):
    return [(r.k, int((r._time - T0).total_seconds() / 60), r._value) for r in df.orderBy("k", "_time").collect()]


def test_time_is_the_window_end(spark):
    df = frame(spark, [("a", 0, 1.0), ("a", 14.99, 3.0), ("a", 15, 5.0)])
    assert shown(aggregate_window(df, "15m", "mean", ["k"])) == [("a", 15, 2.0), ("a", 30, 5.0)]


def test_empty_windows_reach_both_bounds(spark):
    df = frame(spark, [("a", 35, 1.0), ("a", 65, 2.0), (None, 5, 9.0)])
    out = aggregate_window(df, "30m", "max", ["k"], True, T0, T0 + timedelta(hours=2))
    assert shown(out.where("k = 'a'")) == [("a", 30, None), ("a", 60, 1.0), ("a", 90, 2.0), ("a", 120, None)]
    assert out.where("k IS NULL").count() == 4


def test_bounds_off_the_grid_clip_the_last_window(spark):
    df = frame(spark, [("a", 50, 1.0)])
    start, stop = T0 + timedelta(minutes=45), T0 + timedelta(minutes=100)
    out = aggregate_window(df, "30m", "max", ["k"], True, start, stop)
    assert shown(out) == [("a", 60, 1.0), ("a", 90, None), ("a", 100, None)]
    assert expected_windows(start, stop, "30m") == 3


def test_empty_windows_need_bounds(spark):
    with pytest.raises(ValueError):
        aggregate_window(frame(spark, []), "1h", "max", ["k"], True)


def test_all_functions(spark):
    df = frame(spark, [("a", 1, 4.0), ("a", 2, None), ("a", 3, 1.0), ("a", 4, 7.0)])
    names = [*AGGREGATES, "median"]
    row = aggregate_window(df, "1h", names, ["k"]).collect()[0]
    assert [row[n] for n in names] == [4.0, 7.0, 1.0, 12.0, 3, 3.0, 6.0, 4.0, 7.0, 4.0]


def test_count_of_an_empty_window_is_zero(spark):
    df = frame(spark, [("a", 1, 4.0)])
    out = aggregate_window(df, "1h", ["count", "sum"], ["k"], True, T0, T0 + timedelta(hours=2))
    assert [(r["count"], r["sum"]) for r in out.orderBy("_time").collect()] == [(1, 4.0), (0, None)]


def test_median_of_a_window_without_values(spark):
    df = frame(spark, [("a", 1, None), ("a", 61, 2.0)])
    assert shown(aggregate_window(df, "1h", "median", ["k"])) == [("a", 60, None), ("a", 120, 2.0)]


def test_unknown_function(spark):
    with pytest.raises(ValueError):
        aggregate_window(frame(spark, []), "1h", "mode", ["k"])


def test_temperature_reach_over_the_summer_time_change(spark):
    """Room and setpoint per quarter hour; 07:30 local is 06:30 UTC in winter, 05:30 in summer."""
    rows = []
    for day, offset in ((datetime(2025, 3, 28), 1), (datetime(2025, 3, 31), 2)):
        for quarter in range(96):
            time = day + timedelta(minutes=15 * quarter) - timedelta(hours=offset)
            room = 15.0 + max(0, quarter - 30) * 0.5
            rows += [("z", time, "room", room), ("z", time, "set", 21.0)]
    df = spark.createDataFrame(rows, "zone string, _time timestamp, _field string, _value double")
    out = analytics.temperature_reach(df, ["zone"], "room", "set", "Europe/Madrid", "15m")
    assert [(str(r.day), r.minutes_to_reach) for r in out.orderBy("day").collect()] == [
        ("2025-03-28", 150),
        ("2025-03-31", 150),
    ]


def test_data_quality(spark):
    rows = [("a", 10 * i, 20.0 + i % 2) for i in range(12)] + [("a", 300, 95.0), ("b", 0, 1.0)]
    out = {
        r.k: r
        for r in analytics.data_quality(frame(spark, rows), ["k"], T0, T0 + timedelta(hours=6), "30m", "1h").collect()
    }
    assert (out["a"].n_points, out["a"].n_missing_windows, out["a"].n_gaps) == (13, 7, 2)
    assert (out["a"].max_gap_seconds, out["a"].n_outliers) == (190 * 60.0, 1)
    assert (out["b"].n_points, out["b"].n_missing_windows, out["b"].n_gaps, out["b"].max_gap_seconds) == (1, 11, 1, 6 * 3600.0)


def test_data_quality_within_narrow_bounds(spark):
    """Points outside the bounds do not count, and a series without points inside has a row."""
    rows = [("a", -20, 1.0), ("a", 0, 1.0), ("a", 50, 2.0), ("a", 60, 3.0), ("c", 500, 1.0)]
    out = {r.k: r for r in analytics.data_quality(frame(spark, rows), ["k"], T0, T0 + timedelta(hours=1), "30m", "1h").collect()}
    assert (out["a"].n_points, out["a"].n_missing_windows, out["a"].n_gaps, out["a"].max_gap_seconds) == (2, 0, 1, 3000.0)
    assert (out["c"].n_points, out["c"].n_missing_windows, out["c"].n_gaps, out["c"].max_gap_seconds, out["c"].n_outliers) == (0, 2, 1, 3600.0, 0)


def test_empty_windows_of_unfiltered_points(spark):
    df = frame(spark, [("a", -90, 9.0), ("a", 10, 1.0), ("a", 130, 2.0), ("a", 500, 9.0)])
    out = aggregate_window(df, "1h", "max", ["k"], True, T0, T0 + timedelta(hours=3))
    assert shown(out) == [("a", 60, 1.0), ("a", 120, None), ("a", 180, 2.0)]


def test_temperature_before_the_start_hour_does_not_count(spark):
    """A window that ends at the start hour holds earlier readings only."""
    rows = [("z", datetime(2025, 1, 7, 7, 30), f, 21.0) for f in ("room", "set")] + [("z", datetime(2025, 1, 7, 8, 0), f, v) for f, v in (("room", 20.8), ("set", 21.0))]
    df = spark.createDataFrame(rows, "zone string, _time timestamp, _field string, _value double")
    out = analytics.temperature_reach(df, ["zone"], "room", "set", "UTC", "15m").collect()
    assert [(r.minutes_to_reach, r.n_windows) for r in out] == [(15, 1)]


def test_consumption_by_local_days(spark):
    df = frame(spark, [("a", 22 * 60, 1.0), ("a", 22 * 60 + 30, 2.0)])
    out = analytics.consumption_per_day(df, ["k"], "Europe/Madrid").orderBy("day").collect()
    assert [(str(r.day), r.consumption) for r in out] == [("2025-06-01", 1.0), ("2025-06-02", 2.0)]


def test_consumption_counts_midnight_to_the_day_before(spark):
    df = frame(spark, [("a", 30, 1.0), ("a", 24 * 60, 2.0), ("a", 24 * 60 + 30, 4.0)])
    out = analytics.consumption_per_day(df, ["k"]).orderBy("day").collect()
    assert [(str(r.day), r.consumption) for r in out] == [("2025-06-01", 3.0), ("2025-06-02", 4.0)]
