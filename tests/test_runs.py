"""Runs of a condition, intervals between points, and outliers against a moving median."""

from __future__ import annotations

from datetime import datetime, timedelta
from itertools import groupby

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoloom.operators.analytics import data_quality, first_lasting_reach, interval_drift, median_of, moving_outliers, nominal_intervals
from chronoloom.operators.fill import with_recent
from chronoloom.operators.runs import condition_runs, lasting
from chronoloom.operators.slots import Depth

T0 = datetime(2025, 6, 1)
SCHEMA = "k string, _time timestamp, _value double"


def series(seed, n=600):
    rng = np.random.default_rng(seed)
    rows, t = [], 0
    for i in range(n):
        t += int(rng.choice([20, 60, 1800, 3600 * 9], p=[0.5, 0.3, 0.15, 0.05]))
        key = str(rng.choice(["hot", "x", "y"], p=[0.7, 0.2, 0.1]))
        value = float(rng.integers(0, 10)) if rng.random() < 0.9 else None
        rows.append((None if key == "y" else key, T0 + timedelta(seconds=t), 9.0 if 200 < i < 400 else value))
    return rows


def islands(rows, holds):
    out = []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for flag, part in groupby(own, key=holds):
            part = list(part)
            if flag:
                out.append((key, part[0][1], part[-1][1], len(part)))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["5m", "1h", "30d", Depth(7), "50 rows by 6h"])
def test_runs_equal_gaps_and_islands(spark, split):
    rows = series(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = condition_runs(df, ["k"], F.col("_value") >= 5, split=split).collect()
    assert sorted(map(tuple, found), key=str) == islands(rows, lambda r: r[2] is not None and r[2] >= 5)


def test_a_run_over_many_slots_is_one_row(spark):
    rows = [("a", T0 + timedelta(minutes=i), 1.0) for i in range(3000)] + [("b", T0, 1.0), ("b", T0 + timedelta(days=9), 0.0), ("c", T0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = condition_runs(df, ["k"], F.col("_value") > 0, split="1h")
    assert sorted(tuple(r) for r in runs.collect()) == [("a", T0, T0 + timedelta(minutes=2999), 3000), ("b", T0, T0, 1)]
    assert [r.seconds for r in lasting(runs, "1d").collect()] == [2999 * 60]
    assert condition_runs(df.limit(0), ["k"], F.col("_value") > 0).collect() == []


def test_first_stay_near_the_setpoint(spark):
    def at(minute, room):
        return [("z", T0 + timedelta(minutes=minute), "room", room), ("z", T0 + timedelta(minutes=minute), "set", 20.0)]

    temperatures = [15, 20, 20, 17, 20, 20, 20, 20, 20, 18, 20]
    rows = [r for i, v in enumerate(temperatures) for r in at(10 * i, float(v))]
    df = spark.createDataFrame(rows, "k string, _time timestamp, _field string, _value double")
    found = first_lasting_reach(df, ["k"], "room", "set", "UTC", "30m").collect()
    assert [(r.k, r.reached, r.seconds) for r in found] == [("z", T0 + timedelta(minutes=40), 2400.0)]


def test_usual_intervals(spark):
    """Series of 1, 5 and 15 minutes with jitter, losses and a burst are told by their most frequent gap."""
    rng = np.random.default_rng(2)
    rows = []
    for key, minutes in (("one", 1), ("five", 5), ("fifteen", 15)):
        for i in range(400):
            if rng.random() < 0.8:
                rows.append((key, T0 + timedelta(minutes=minutes * i, seconds=float(rng.uniform(0, 4))), 1.0))
    rows += [("fifteen", T0 + timedelta(seconds=i), 1.0) for i in range(30)] + [("lone", T0, 1.0), ("lone", T0, 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.k: r.nominal_seconds for r in nominal_intervals(df, ["k"], "1m").collect()}
    assert found == {"one": 60, "five": 300, "fifteen": 900}
    changed = [("d", T0 + timedelta(minutes=5 * i), 1.0) for i in range(600)] + [("d", T0 + timedelta(minutes=3000 + 15 * i), 1.0) for i in range(150)]
    drift = interval_drift(spark.createDataFrame(changed, SCHEMA), ["k"]).collect()
    assert {(r.nominal_seconds, r.usual_seconds) for r in drift} == {(900, 300)} and len(drift) == 2


def test_quality_against_each_series_own_interval(spark):
    times = lambda step, skip: [T0 + timedelta(minutes=step * i) for i in range(1440 // step) if i not in skip]
    rows = [("a", t, 1.0) for t in times(5, {10, 11})] + [("b", t, 1.0) for t in times(15, {3})] + [("c", T0, 1.0)] + [("out", T0 - timedelta(days=3), 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.k: r for r in data_quality(df, ["k"], "2025-06-01", "2025-06-02", unit="1m").collect()}
    shown = {k: (r.nominal_seconds, r.n_points, r.n_missing_windows, r.n_gaps, r.max_gap_seconds) for k, r in found.items()}
    assert shown == {"a": (300, 286, 2, 1, 900.0), "b": (900, 95, 1, 1, 1800.0), "c": (86400, 1, 0, 0, 86400.0), "out": (86400, 0, 1, 0, 86400.0)}
    given = {r.k: (r.n_missing_windows, r.n_gaps) for r in data_quality(df, ["k"], "2025-06-01", "2025-06-02", "15m").collect()}
    assert given == {"a": (0, 0), "b": (1, 1), "c": (95, 1), "out": (96, 1)}


@pytest.mark.parametrize("split", [None, "5m", "1d", "40 rows"])
def test_moving_median_equals_pandas(spark, split):
    rows = series(4)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r.k, r._time): r for r in moving_outliers(df, ["k"], 9, 3.0, split=split).collect()}
    assert len(found) == len(rows)
    for key in ("hot", "x", None):
        own = pd.DataFrame(sorted((r for r in rows if r[0] == key), key=lambda r: r[1]), columns=["k", "t", "v"])
        medians = own["v"].rolling(9, min_periods=1).median()
        for t, v, m in zip(own["t"], own["v"], medians, strict=True):
            r = found[(key, t.to_pydatetime())]
            assert (r.median is None and pd.isna(m)) or r.median == pytest.approx(m)
            assert not (pd.isna(v) and r.outlier)


def test_a_step_in_level_is_soon_usual(spark):
    noise = [0.0, 0.2, -0.1, 0.1, -0.2, 0.3]
    values = [10 + noise[i % 6] for i in range(50)] + [50 + noise[i % 6] for i in range(50)]
    values[20] = 30.0
    rows = [("s", T0 + timedelta(minutes=i), v) for i, v in enumerate(values)]
    marked = moving_outliers(spark.createDataFrame(rows, SCHEMA), ["k"], 11, 6.0, split="10m").where("outlier").orderBy("_time").collect()
    minutes = [int((r._time - T0).total_seconds() // 60) for r in marked]
    assert 20 in minutes and min(m for m in minutes if m > 20) == 50 and max(minutes) <= 60


def test_medians_and_recent_rows(spark):
    rows = spark.createDataFrame([([3.0, 1.0],), ([2.0],), ([],), ([5.0, 1.0, 3.0],)], "a array<double>")
    assert [r[0] for r in rows.select(median_of(F.col("a"))).collect()] == [2.0, 2.0, None, 3.0]
    with pytest.raises(ValueError):
        with_recent(rows, ["a"], "a", 0, "r")
