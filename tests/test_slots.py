"""Slots by counts: even sizes, and results that do not depend on the slots."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_fill import SCHEMA, T0, expected, frame, random_rows, records

from chronoloom.operators.fill import difference, fill_limited, fill_previous, with_lags
from chronoloom.operators.slots import SLOT, Depth, parsed, with_slot
from chronoloom.plans.query import run_query
from chronoloom.plans.stages import LagFeatures

SPLITS = ["7 rows", "40 rows by 10m", Depth(3, "1d"), Depth(10_000)]


def test_text_of_slots():
    assert parsed("100 rows") == Depth(100, "1h") and parsed("5 rows by 10m") == Depth(5, "10m")
    assert parsed("1h") == "1h" and parsed(Depth(3)) == Depth(3)


@pytest.mark.parametrize("split", SPLITS)
def test_fills_do_not_depend_on_slots(spark, split):
    pdf = random_rows(11)

    def both_ways(g):
        g[["a", "b"]] = g[["a", "b"]].ffill(limit=2).bfill(limit=2)
        return g

    def previous(g):
        g[["a", "b"]] = g[["a", "b"]].ffill()
        return g

    df = frame(spark, pdf)
    assert records(fill_limited(df, ["k"], ["_time"], ["a", "b"], 2, split)) == expected(pdf, both_ways)
    assert records(fill_previous(df, ["k"], ["a", "b"], split=split)) == expected(pdf, previous)
    whole = records(difference(df, ["k"], ["a"]))
    assert records(difference(df, ["k"], ["a"], split=split)) == whole


@pytest.mark.parametrize("split", [*SPLITS, "5m", "1d"])
def test_lags_do_not_depend_on_slots(spark, split):
    df = frame(spark, random_rows(12))
    columns = ("k", "_time", "a", "b", "one", "five")
    wanted = records(with_lags(df, ["k"], "a", {"one": 1, "five": 5}), columns)
    assert records(with_lags(df, ["k"], "a", {"one": 1, "five": 5}, split=split), columns) == wanted
    stage = LagFeatures(inputCol="a", keys=["k"], lags=[2], split=split if isinstance(split, str) else f"{split.rows} rows")
    plain = LagFeatures(inputCol="a", keys=["k"], lags=[2])
    assert sorted(map(str, stage.transform(df).collect())) == sorted(map(str, plain.transform(df).collect()))


def test_slots_hold_equally_many_rows(spark):
    """Series of 1, 100 and 10,000 rows an hour, a burst among them: no slot over twice the median, few slots for the sparse."""
    rng = np.random.default_rng(5)
    hours = spark.range(72).select(F.col("id").alias("h"))
    dense = hours.select("h", F.explode(F.sequence(F.lit(0), F.lit(9999))).alias("i")).select(F.lit("dense").alias("k"), F.expr("h * 3600 + i * 0.36").alias("s"))
    even = hours.select("h", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i")).select(F.lit("even").alias("k"), F.expr("h * 3600 + i * 36").alias("s"))
    sparse = hours.select(F.lit("sparse").alias("k"), (F.col("h") * 3600).alias("s"))
    burst = spark.createDataFrame([("burst", float(x)) for x in np.sort(rng.uniform(0, 40 * 3600, 800)).tolist() + np.linspace(7200, 10_800, 3000).tolist()], "k string, s double")
    points = dense.union(even).union(sparse).union(burst).select("k", F.timestamp_micros((F.col("s") * 1e6 + 1.7e15).cast("long")).alias("_time"))
    sizes = with_slot(points, ["k"], "_time", Depth(1000, "30m")).groupBy("k", SLOT).count().collect()
    by = {k: sorted(r["count"] for r in sizes if r["k"] == k) for k in ("dense", "even", "sparse", "burst")}
    assert len(by["sparse"]) == 1 and len(by["even"]) in (7, 8) and sum(by["dense"]) == 720_000
    every = sorted(r["count"] for r in sizes)
    assert every[-1] <= 2 * every[len(every) // 2]


def test_slots_never_fall_with_time(spark):
    pdf = random_rows(13)
    rows = with_slot(frame(spark, pdf), ["k"], "_time", Depth(9, "2h")).select("k", "_time", SLOT).collect()
    for k in {r["k"] for r in rows}:
        own = sorted((r["_time"], r[SLOT]) for r in rows if r["k"] == k)
        assert [s for _, s in own] == sorted(s for _, s in own)
        assert all(a[1] == b[1] for a, b in zip(own, own[1:]) if a[0] == b[0])


def test_numeric_times_one_instant_and_no_rows(spark):
    rows = [("s", i // 5, float(i) if i % 3 else None, 0.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, _time long, a double, b double")
    got = fill_limited(df, ["k"], ["_time", "b", "a"], ["a"], 2, Depth(10, "5s")).count()
    assert got == 100
    bunch = spark.createDataFrame([("s", T0, 1.0, 0.0)] * 50 + [("s", T0 + timedelta(days=9), None, 0.0), ("s", None, 3.0, 0.0)], SCHEMA)
    slots = with_slot(bunch, ["k"], "_time", Depth(10))
    assert slots.where(F.col("_time") == F.lit(T0)).select(SLOT).distinct().count() == 1
    assert slots.count() == 52
    assert with_slot(bunch.limit(0), ["k"], "_time", Depth(10)).collect() == []


def test_queries_take_slots_by_counts(spark):
    pdf = random_rows(14)
    df = frame(spark, pdf).withColumnRenamed("a", "_value").drop("b")
    steps = {"difference": {"non_negative": "true"}}
    plain = run_query(df, steps, keys=["k"]).collect()
    assert sorted(map(str, run_query(df, steps, keys=["k"], slot="25 rows").collect())) == sorted(map(str, plain))
