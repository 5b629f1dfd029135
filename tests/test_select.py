from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st

from chronoloom.operators import select
from chronoloom.operators.fuse import common_type, fuse, union_buckets
from chronoloom.schema import duration_seconds, parse_instant, point_schema, series_keys
from pyspark.sql import types as T

T0 = datetime(2025, 6, 1)


def frame(spark):
    rows = [("b0", "m", T0 + timedelta(hours=i), f"f{i % 3}", float(i), None if i == 4 else "x") for i in range(6)]
    return spark.createDataFrame(rows + [("_b9", "m", T0, "f0", 0.0, "y")], point_schema(["tag"]))


def test_range_is_half_open(spark):
    df = frame(spark)
    assert select.time_range(df, T0, T0 + timedelta(hours=3)).where("bucket = 'b0'").count() == 3
    assert select.time_range(df, 1748736000, "2025-06-01T02:00:00.000Z").where("bucket = 'b0'").count() == 2
    assert select.time_range(df, "-2h", as_of=T0 + timedelta(hours=5)).count() == 3


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    frame(spark).write.partitionBy("bucket").parquet(path)
    df = select.in_buckets(select.time_range(spark.read.parquet(path), T0), "b0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_time" in plan and "(bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_missing_tags_never_match(spark):
    assert select.tag_is_not(frame(spark), "tag", "y").count() == 5
    assert select.tag_is(frame(spark), "tag", ["x", "y"]).count() == 6


def test_buckets(spark):
    df = frame(spark)
    assert [r[0] for r in select.bucket_names(df).collect()] == ["b0"]
    assert select.in_buckets(df, "all").count() == 6
    assert select.in_buckets(df, ["all_buckets"], exclude=["b0"]).count() == 0
    assert select.in_buckets(df, ["b0", "_b9"]).count() == 7


def test_contains_with_a_frame(spark):
    members = spark.createDataFrame([("f1",), ("f1",), ("f2",)], "name string")
    assert select.contains(frame(spark), "_field", members).count() == 4
    assert select.contains(frame(spark), "_field", ["f0"]).count() == 3


def test_field_keys(spark):
    df = frame(spark)
    assert select.field_keys(df, "2025-09-09T00:00:00Z").count() == 3
    assert select.field_keys(df, "2025-09-10T00:00:00Z").count() == 0


def test_keep_ignores_absent_columns(spark):
    assert select.keep(frame(spark), ["_value", "absent", "bucket"]).columns == ["bucket", "_value"]


def test_rows_with_missing_counts_nan(spark):
    df = spark.createDataFrame([(1.0, 1, "a"), (float("nan"), 2, None), (None, 3, "c")], "a double, b long, s string")
    assert sorted(r.b for r in select.rows_with_missing(df).collect()) == [2, 3]
    assert select.rows_with_missing(df.select("s")).count() == 0
    assert select.complete_rows(df).count() == 1


def test_series_keys(spark):
    assert series_keys(frame(spark)) == ["bucket", "_measurement", "_field", "tag"]


def test_fuse_reconciles_types(spark):
    a = spark.createDataFrame([(1, "x", 1)], "n int, code string, only long")
    b = spark.createDataFrame([(2.5, 7)], "n double, code long")
    out = fuse([a, b])
    assert dict(out.dtypes) == {"n": "double", "code": "string", "only": "bigint"}
    assert sorted(map(tuple, out.collect())) == [(1.0, "x", 1), (2.5, "7", None)]
    with pytest.raises(ValueError):
        fuse([])


def test_common_type():
    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert common_type([T.NullType(), T.DoubleType()]) == T.DoubleType()
    assert common_type([T.BooleanType(), T.LongType()]) == T.StringType()


def test_union_buckets_tags_rows(spark):
    one = spark.createDataFrame([(1.0,)], "_value double")
    out = union_buckets({"b0": one, "b1": one.withColumnRenamed("_value", "other")})
    assert sorted((r.bucket, r._value, r.other) for r in out.collect()) == [("b0", 1.0, None), ("b1", None, 1.0)]


def test_durations():
    assert duration_seconds("30m") == 1800 and duration_seconds("1h30m") == 5400
    assert duration_seconds("5 minutes") == 300 and duration_seconds(7) == 7
    for bad in ("", "m", "5x", "5m!"):
        with pytest.raises(ValueError):
            duration_seconds(bad)


def test_instants():
    assert parse_instant("2025-01-7T00:00:00.211Z") == datetime(2025, 1, 7, 0, 0, 0, 211000)
    assert parse_instant("2025-06-01T02:00:00+02:00") == T0
    assert parse_instant("1748736000") == parse_instant(1748736000) == T0
    with pytest.raises(ValueError):
        parse_instant("-1h")
    with pytest.raises(ValueError):
        parse_instant("yesterday")


@given(st.datetimes(min_value=datetime(1971, 1, 1), max_value=datetime(2100, 1, 1)))
def test_instants_round_trip(moment):
    assert parse_instant(moment.isoformat() + "Z") == moment
