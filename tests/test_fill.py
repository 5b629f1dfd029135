from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from chronoloom.operators.fill import difference, fill_limited, fill_previous, with_previous

T0 = datetime(2025, 6, 1)
SCHEMA = "k string, _time timestamp, a double, b double"


def random_rows(seed: int, n: int = 400) -> pd.DataFrame:
    """Bursts and long silences, runs of nulls, one key with most of the rows, one null key."""
    rng = np.random.default_rng(seed)
    keys = rng.choice(["hot", "x", "y", None], size=n, p=[0.6, 0.2, 0.15, 0.05])
    gaps = rng.choice([20, 60, 1800, 3600 * 7], size=n, p=[0.5, 0.3, 0.15, 0.05])
    times = [T0 + timedelta(seconds=int(s)) for s in np.cumsum(gaps)]
    a = np.where(rng.random(n) < 0.55, np.nan, rng.integers(0, 100, n))
    b = np.where(rng.random(n) < 0.85, np.nan, rng.integers(0, 100, n))
    return pd.DataFrame({"k": keys, "_time": times, "a": a, "b": b})


def clean(rows) -> list[tuple]:
    """Rows with plain Python values and None for everything missing."""
    return [
        tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else None if pd.isna(v) else v for v in row)
        for row in rows
    ]


def frame(spark, pdf: pd.DataFrame):
    return spark.createDataFrame(clean(pdf.itertuples(index=False)), SCHEMA)


def records(df, columns=("k", "_time", "a", "b")):
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def expected(pdf: pd.DataFrame, fn):
    parts = [fn(g.sort_values("_time").copy()) for _, g in pdf.groupby("k", dropna=False)]
    out = clean(pd.concat(parts)[["k", "_time", "a", "b"]].itertuples(index=False))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("split", [None, "5m", "1h", "1d"])
@pytest.mark.parametrize("seed", [1, 2])
def test_limited_fill_equals_pandas(spark, seed, split):
    pdf = random_rows(seed)

    def fill(g):
        g[["a", "b"]] = g[["a", "b"]].ffill(limit=2).bfill(limit=2)
        return g

    ours = records(fill_limited(frame(spark, pdf), ["k"], ["_time"], ["a", "b"], 2, split))
    assert ours == expected(pdf, fill)


@pytest.mark.parametrize("limit", [1, 3])
def test_limited_fill_other_limits(spark, limit):
    pdf = random_rows(7)

    def fill(g):
        g[["a", "b"]] = g[["a", "b"]].ffill(limit=limit).bfill(limit=limit)
        return g

    ours = records(fill_limited(frame(spark, pdf), ["k"], ["_time"], ["a", "b"], limit, "10m"))
    assert ours == expected(pdf, fill)


def test_gaps_of_one_to_five_rows(spark):
    values = [1.0, None, 2.0, None, None, 3.0, None, None, None, 4.0, None, None, None, None, 5.0]
    values += [None] * 5 + [6.0]
    rows = [("s", T0 + timedelta(minutes=i), v, 0.0) for i, v in enumerate(values)]
    wanted = [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 4, 5, 5, 5, 5, 5, None, 6, 6, 6]
    for split in (None, "3m"):
        out = fill_limited(spark.createDataFrame(rows, SCHEMA), ["k"], ["_time"], ["a"], 2, split)
        assert [r.a for r in out.orderBy("_time").collect()] == wanted


@pytest.mark.parametrize("split", [None, "5m", "1d"])
def test_fill_previous_equals_pandas(spark, split):
    pdf = random_rows(3)

    def fill(g):
        g[["a", "b"]] = g[["a", "b"]].ffill()
        return g

    assert records(fill_previous(frame(spark, pdf), ["k"], ["a", "b"], split=split)) == expected(pdf, fill)


@pytest.mark.parametrize("split", [None, "5m", "1d"])
@pytest.mark.parametrize("non_negative", [False, True])
def test_difference_equals_pandas(spark, split, non_negative):
    pdf = random_rows(4)

    def delta(g):
        for c in ("a", "b"):
            d = g[c] - g[c].ffill().shift()
            g[c] = d.where(d >= 0) if non_negative else d
        return g.iloc[1:]

    ours = records(difference(frame(spark, pdf), ["k"], ["a", "b"], non_negative=non_negative, split=split))
    assert ours == expected(pdf, delta)


def test_counter_reset_is_null(spark):
    rows = [("s", T0 + timedelta(hours=i), v, 0.0) for i, v in enumerate([5.0, 9.0, 2.0, 4.0])]
    out = difference(spark.createDataFrame(rows, SCHEMA), ["k"], ["a"], non_negative=True)
    assert [r.a for r in out.orderBy("_time").collect()] == [4.0, None, 2.0]


def test_first_row_is_marked_once_per_series(spark):
    pdf = random_rows(5)
    out = with_previous(frame(spark, pdf), ["k"], {"a": "before"}, split="5m", first_flag="first")
    assert out.where("first").count() == pdf["k"].nunique(dropna=False)


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for split in (None, "1h"):
        assert fill_limited(empty, ["k"], ["_time"], ["a"], 2, split).count() == 0
        assert fill_previous(empty, ["k"], ["a"], split=split).count() == 0
        assert difference(empty, ["k"], ["a"], split=split).count() == 0
