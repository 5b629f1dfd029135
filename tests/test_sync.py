from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest

from chronoloom.functions import numeric, timefn
from chronoloom.operators.reshape import pivot_last, pivot_mean, plot_series, wide_to_points
from chronoloom.operators.sync import on_grid, synchronise

T0 = datetime(2025, 6, 1)
POINTS = "_time timestamp, system_id string, floor string, equipment_number string, _field string, _value double"


def point(minutes: float, field: str, value, system="s", floor="f", equipment="e"):
    return (T0 + timedelta(minutes=minutes), system, floor, equipment, field, value)


def frame(spark, rows):
    return spark.createDataFrame(rows, POINTS)


def test_mean_of_means(spark):
    """Two readings at one instant count once: (mean(0, 10) + 20) / 2, not the mean of three."""
    rows = [point(0, "a", 0.0), point(0, "a", 10.0), point(1, "a", 20.0)]
    assert on_grid(frame(spark, rows), ["a"]).collect()[0].a == 12.5


def test_null_keys_and_missing_values_are_dropped(spark):
    rows = [point(0, "a", 1.0), point(0, "a", 2.0, floor=None), point(5, "a", None), point(10, "a", float("nan"))]
    assert [r.a for r in on_grid(frame(spark, rows), ["a"]).collect()] == [1.0]


def test_grid_time_is_ceiled_then_rounded(spark):
    seconds = {0.0: 0, 1.0: 0, 2.0: 0, 2.001: 300, 2.5: 300, 7.0: 300, 7.01: 600}
    for minutes, wanted in seconds.items():
        row = on_grid(frame(spark, [point(minutes, "a", 1.0)]), ["a"]).collect()[0]
        assert row._time - int(pd.Timestamp(T0).timestamp()) == wanted, minutes


def test_ties_round_to_the_even_multiple(spark):
    df = spark.createDataFrame([(s,) for s in (900, 2700, 5400, 1800, 1801, 1799)], "s long")
    out = [r[0] for r in df.select(timefn.round_seconds(df.s, "1h")).collect()]
    assert out == [0, 3600, 7200, 0, 3600, 0]


def test_fill_scope(spark):
    """By system a gap is filled from the neighbouring device, by series only from itself."""
    rows = [point(0, "a", 1.0, equipment="e1"), point(0, "b", 5.0, equipment="e1"), point(0, "a", 2.0, equipment="e2")]
    by_system = synchronise(frame(spark, rows), ["a", "b"]).orderBy("equipment_number").collect()
    assert [(r.a, r.b) for r in by_system] == [(1.0, 5.0), (2.0, 5.0)]
    by_series = synchronise(frame(spark, rows), ["a", "b"], fill_scope="series").collect()
    assert [(r.equipment_number, r.b) for r in by_series] == [("e1", 5.0)]
    with pytest.raises(ValueError):
        synchronise(frame(spark, rows), ["a"], fill_scope="other")


def test_empty_input_gives_empty_output(spark):
    out = synchronise(frame(spark, []), ["a", "b"])
    assert out.count() == 0
    assert out.columns == ["_time", "system_id", "floor", "equipment_number", "a", "b"]


def test_narrowing(spark):
    df = spark.createDataFrame([(300.7,), (-1.9,), (127.9,), (128.0,), (-129.0,), (None,)], "v double")
    wrap = [r[0] for r in df.select(numeric.int8_wrap(df.v)).collect()]
    assert wrap == [44, -1, 127, -128, 127, None]
    safe = [r[0] for r in df.select(numeric.int8_try(df.v)).collect()]
    assert safe == [None, -1, 127, None, None, None]
    rows = [point(0, "room_temperature", 20.3), point(0, "mode", 300.7)]
    out = synchronise(frame(spark, rows), ["room_temperature", "mode"], narrow="wrap").collect()[0]
    assert out.room_temperature == 20.296875 and out.mode == 44
    with pytest.raises(ValueError):
        synchronise(frame(spark, rows), ["mode"], narrow="other")


def test_against_a_pandas_reading(spark):
    """The whole chain on irregular points of several systems, in both split forms."""
    import numpy as np

    rng = np.random.default_rng(11)
    n = 900
    pdf = pd.DataFrame(
        {
            "_time": [T0 + timedelta(seconds=int(s)) for s in rng.integers(0, 6 * 3600, n)],
            "system_id": rng.choice(["s1", "s2", "s3"], n, p=[0.7, 0.2, 0.1]),
            "floor": rng.choice(["f1", "f2"], n),
            "equipment_number": rng.choice(["e1", "e2"], n),
            "_field": rng.choice(["a", "b"], n),
            "_value": rng.integers(0, 50, n).astype(float),
        }
    )
    keys = ["_time", "system_id", "floor", "equipment_number"]
    wide = pdf.pivot_table(index=keys, columns="_field", values="_value").reset_index()
    wide["_time"] = wide["_time"].dt.ceil("min").dt.round("5min")
    wide = wide.groupby(keys).mean().reset_index()
    parts = [g.sort_values(keys).ffill(limit=2).bfill(limit=2) for _, g in wide.groupby("system_id")]
    wanted = pd.concat(parts).dropna()
    epoch = (wanted["_time"] - pd.Timestamp(0)) // pd.Timedelta(seconds=1)
    wanted = sorted(zip(epoch, wanted.system_id, wanted.floor, wanted.equipment_number, wanted.a, wanted.b))
    rows = [(t.to_pydatetime(), *rest) for t, *rest in pdf.itertuples(index=False)]
    for split in (None, "10m", "1h"):
        ours = sorted(tuple(r) for r in synchronise(frame(spark, rows), ["a", "b"], split=split).collect())
        assert [r[:4] for r in ours] == [tuple(r[:4]) for r in wanted]
        assert [r[4:] for r in ours] == [pytest.approx(r[4:]) for r in wanted]


def test_pivots(spark):
    rows = [point(0, "a", 1.0), point(0, "a", 3.0), point(0, "b", 2.0), point(1, "b", None)]
    mean = pivot_mean(frame(spark, rows), ["_time", "system_id"], ["a", "b"]).collect()
    assert [(r.a, r.b) for r in mean] == [(2.0, 2.0)]
    last = pivot_last(frame(spark, rows), ["system_id"], ["a", "b"], order=["_time"]).collect()
    assert [(r.a, r.b) for r in last] == [(3.0, None)]


def test_wide_to_points_types(spark):
    df = spark.createDataFrame([("x", 1, 2.5, "t", True), ("y", None, 3.5, None, False)], "id string, n long, d double, s string, f boolean")
    numbers = wide_to_points(df, ["id"], ["n", "d"])
    assert dict(numbers.dtypes)["_value"] == "double" and numbers.count() == 3
    assert dict(wide_to_points(df, ["id"], ["s", "n"]).dtypes)["_value"] == "string"
    assert dict(wide_to_points(df, ["id"], ["f"]).dtypes)["_value"] == "boolean"


def test_plot_series_names(spark):
    df = spark.createDataFrame([("b0", T0, 1.0, None)], "bucket string, _time timestamp, a double, b double")
    out = {(r.name, r.y) for r in plot_series(df, ["a", "b"]).collect()}
    assert out == {("b0-a", 1.0), ("b0-b", None)}


def test_time_functions(spark):
    df = spark.createDataFrame([("2025-01-7T00:00:00.211Z",), ("2025-07-01T12:00:00+02:00",), ("junk",)], "t string")
    out = [r[0] for r in df.select(timefn.parse_rfc3339(df.t)).collect()]
    assert out == [datetime(2025, 1, 7, 0, 0, 0, 211000), datetime(2025, 7, 1, 10), None]
    zone = spark.createDataFrame([(datetime(2025, 1, 15, 6, 30),), (datetime(2025, 7, 15, 5, 30),)], "t timestamp")
    local = [r[0].hour for r in zone.select(timefn.local_time(zone.t, "Europe/Madrid")).collect()]
    assert local == [7, 7]
    early = spark.createDataFrame([(datetime(1969, 12, 31, 23, 58, 30),)], "t timestamp")
    assert early.select(timefn.ceil_to(early.t)).collect()[0][0] == -60
