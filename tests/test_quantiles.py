from __future__ import annotations

import numpy as np
import pytest

from chronoloom.operators.profile import describe, profile_columns, result_views
from chronoloom.operators import quantiles as by_counting
from chronoloom.operators.quantiles import quantiles, ranks

PROBS = {"q0": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99, "q100": 1.0}


def check(spark, groups: dict):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double")
    out = {r.k: r for r in quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(out) == set(groups)
    for k, values in groups.items():
        for name, p in PROBS.items():
            assert out[k][name] == pytest.approx(np.quantile(np.array(values, dtype=float), p), rel=1e-12), (k, name)


def test_shapes_of_groups(spark):
    rng = np.random.default_rng(5)
    check(
        spark,
        {
            "one": [7.0],
            "two": [3.0, -4.0],
            "constant": [5.5] * 300,
            "mostly one value": [1.0] * 500 + [2.0, 3.0],
            "negative": list(-rng.exponential(50, 400)),
            "close together": list(1e6 + rng.random(500) * 1e-6),
            "wide": list(10.0 ** rng.uniform(-8, 12, 400) * rng.choice([-1, 1], 400)),
            "integers": list(rng.integers(0, 5, 333)),
            None: list(rng.normal(0, 1, 50)),
        },
    )


def test_hot_group(spark):
    rng = np.random.default_rng(6)
    check(spark, {"hot": list(rng.normal(20, 0.01, 20000)), "cold": list(rng.normal(0, 1, 20))})


def test_without_broadcast_joins(spark):
    """Null keys meet in sort-merge joins too."""
    rng = np.random.default_rng(9)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        check(spark, {"a": list(rng.normal(0, 1, 200)), None: list(rng.integers(0, 9, 100)), "b": [1.0]})
        check(spark, {"hot": [20.5] * 9000 + list(rng.normal(20, 1, 1000)), "cold": list(rng.normal(0, 1, 20))})
    finally:
        for name in names:
            spark.conf.unset(name)


def test_missing_and_signed_zero(spark):
    rows = [("a", None), ("a", float("nan")), ("a", 0.0), ("a", -0.0), ("a", 1.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = quantiles(df, ["k"], "v", {"m": 0.5}).collect()
    assert [(r.k, r.m) for r in out] == [("a", 0.0)]


def test_needs_keys(spark):
    with pytest.raises(ValueError):
        quantiles(spark.range(3), [], "id", {"m": 0.5})


def test_several_keys(spark):
    rows = [("a", i % 3, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, j long, v double")
    out = {(r.k, r.j): r.m for r in quantiles(df, ["k", "j"], "v", {"m": 0.5}).collect()}
    assert out == {("a", 0): 13.5, ("a", 1): 14.5, ("a", 2): 15.5}


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), float(v) if v > 0 else None, "t") for i, v in enumerate(rng.normal(1, 2, 500))]
    df = spark.createDataFrame(rows, "i long, v double, s string")
    out = {r["column"]: r for r in describe(df).collect()}
    assert set(out) == {"i", "v"}
    wanted = df.select("i", "v").toPandas().describe()
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "25%": "q25", "50%": "q50", "75%": "q75", "max": "max"}
    for c in ("i", "v"):
        for theirs, ours in names.items():
            assert out[c][ours] == pytest.approx(wanted[c][theirs])


def test_sketched_describe(spark):
    df = spark.range(1, 1002).select("id")
    assert tuple(describe(df, exact=False).collect()[0]) == tuple(describe(df).collect()[0])


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    out = {r["column"]: r for r in describe(df).collect()}
    assert out["a"]["count"] == 0 and out["a"]["q50"] is None and out["b"]["q50"] == 1.5


def test_profile_forms_agree_on_small_data(spark):
    rows = [(i % 7, None if i % 3 else "x", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    exact = sorted(profile_columns(df, exact=df.columns).collect())
    wanted = [("a", "bigint", 100, 0, 7), ("b", "string", 100, 66, 1), ("c", "double", 100, 0, 100)]
    assert [tuple(r) for r in exact] == wanted
    sketched = {r["column"]: r for r in profile_columns(df).collect()}
    assert sketched["b"]["n_nulls"] == 66 and abs(sketched["c"]["n_distinct"] - 100) < 10


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a long, b string")
    wanted = [("a", "bigint", 0, 0, 0), ("b", "string", 0, 0, 0)]
    for exact in ((), ("b",), ("a", "b")):
        assert sorted(tuple(r) for r in profile_columns(df, exact=exact).collect()) == wanted


def test_values_are_counted_in_one_wide_shuffle(spark):
    """The table is read once and no raw row stands under a join."""
    df = spark.range(1000).selectExpr("cast(id % 3 as string) as k", "cast(id % 50 as double) as v")
    out = quantiles(df, ["k"], "v", {"m": 0.5})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Join")[1:]:
        assert part.count("Range (") <= part.count("count(1)")


def test_result_views(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3.0, None)], "i long, v double, s string")
    views = result_views(df)
    assert [tuple(r) for r in views["missing"].collect()] == [(1, None)]
    assert dict(map(tuple, views["dtypes"].collect())) == {"i": "bigint", "v": "double", "s": "string"}
    assert views["description"].count() == 2 and views["table"] is df


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_ranks_by_counting(spark, monkeypatch, frequent):
    monkeypatch.setattr(by_counting, "FREQUENT", frequent)
    rng = np.random.default_rng(7)
    groups = {
        "ties": list(rng.integers(0, 9, 200).astype(float)),
        "close": list(1e6 + rng.random(300) * 1e-6),
        "odd": [0.0, -0.0, float("inf"), float("-inf"), float("nan"), float("nan"), None, None, -3.5, 1e308, -1e308],
        None: list(rng.normal(0, 1, 50)),
    }
    rows = [(k, i, None if v is None else float(v)) for k, values in groups.items() for i, v in enumerate(values)]
    got = {(r.k, r.i): r["rank"] for r in ranks(spark.createDataFrame(rows, "k string, i long, v double"), ["k"], "v", "rank").collect()}

    def place(v):
        return (2, 0.0) if v is None else (1, 0.0) if v != v else (0, v)

    wanted = {(k, i): 1 + sum(place(w) < place(v) for w in values) for k, values in groups.items() for i, v in enumerate(values)}
    assert got == wanted


def test_ranks_of_a_bucket_bound_the_groups_of_pandas(spark, sf_dir, monkeypatch):
    from chronoloom.workload import queries

    given = []
    monkeypatch.setattr(queries, "predict_groups", lambda df, predict, schema, keys: given.append((df, keys)) or df)
    queries.QUERIES["pandas_model_whole_groups"](spark, sf_dir)
    (df, keys), = given
    names = df.groupBy(*keys).count().columns[:-1]
    assert set(queries.SERIES) <= set(names) and "slot" in names
