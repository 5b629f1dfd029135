from __future__ import annotations

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from chronoloom.plans import pipes
from chronoloom.plans.plan import check_plan, file_source, fill_parameters, read_plan, run_plan, series_source, sql_source
from chronoloom.plans.query import ordered_steps, rerange, run_query
from chronoloom.plans.stages import Centre, CentreModel, Described, Fuse, Synchronise, moments, predict_groups, predict_rows_per_bucket
from chronoloom.schema import point_schema

T0 = datetime(2025, 6, 1)
STOP = "2025-06-02T00:00:00Z"
RANGE = {"start": "2025-06-01T00:00:00Z", "stop": STOP}


@pytest.fixture(scope="module")
def points(spark):
    rows = [
        (b, m, T0 + timedelta(minutes=7 * i), f, float(i * k), str(i % 2))
        for k, b in enumerate(("b0", "b1", "_internal"), start=1)
        for m, f in (("m1", "f1"), ("m1", "f2"), ("m2", "f3"))
        for i in range(12)
    ]
    return spark.createDataFrame(rows, point_schema(["floor"]))


def test_steps_in_both_forms(points):
    as_dict = {"bucket": {"bucket": ["b0"]}, "range": RANGE, "filter_field": [{"field": "f1"}, {"field": "f3"}]}
    as_list = [{k: v} for k, v in as_dict.items()]
    assert run_query(points, as_dict).count() == run_query(points, as_list).count() == 24
    with pytest.raises(ValueError):
        run_query(points, {"no_such_step": {}})


def test_negative_lists_exclude_every_member(points):
    steps = [{"bucket": {"bucket": "b0"}}, {"filter_not_field": [{"field": "f1"}, {"field": "f2"}]}]
    assert {r[0] for r in run_query(points, steps).select("_field").distinct().collect()} == {"f3"}


def test_range_override_touches_only_ranges():
    steps = ordered_steps([{"range": {"start": 0, "stop": 1}}, {"filter_field": {"field": "start"}}])
    assert rerange(steps, start=5)[0] == ("range", {"start": 5, "stop": 1})
    assert rerange(steps, start=5)[1] == steps[1]


def test_relative_range(points):
    out = run_query(points, {"bucket": {"bucket": "b0"}, "last_hours": {"start": "-1h"}}, as_of="2025-06-01T01:00:00Z")
    assert out.count() == 36


def test_group_merges_series(points):
    steps = {
        "bucket": {"bucket": ["b0", "b1"]},
        "range": RANGE,
        "group": {"columns": ["bucket"]},
        "window_aggregation": {"every": "1h", "function": "count", "create_empty": "true"},
        "fill": {"columns": "_value", "previous": "true"},
        "sort": {"columns": ["_time"]},
    }
    out = run_query(points, steps)
    assert out.columns == ["bucket", "_time", "_value"] and out.count() == 48


def test_drop_column_widens_series(points):
    steps = {"drop_columns": {"columns": ["floor"]}, "difference": {"non_negative": "false"}}
    out = run_query(points, steps)
    assert out.count() == 9 * 11 and "floor" not in out.columns


def test_plan_must_name_steps_and_sources(spark, tmp_path):
    with pytest.raises(ValueError, match="data_sources"):
        check_plan({"p": {"steps": {}}})
    (tmp_path / "plan.json").write_text(json.dumps({"p": {"steps": {}, "data_sources": {}}}, indent=2))
    assert "p" in read_plan(spark, str(tmp_path / "plan.json"))


@pytest.fixture
def demo(spark, points, tmp_path):
    (tmp_path / "extra.csv").write_text("_value,note\n5.5,from file\n")
    spark.range(20).select(F.col("id").alias("n"), (F.col("id") * 100.0).alias("level")).createOrReplaceTempView("levels")
    entry = {
        "steps": {"Fuse": {"relational": {"table": "levels", "filter_field": "level", "filter_value": 500.0, "limit": 10}}},
        "data_sources": {
            "series": {"buckets": ["all"], "range": RANGE, "filter_field": [{"field": "f1"}, {"field": "f2"}]},
            "relational": ["SELECT * FROM {table}", "WHERE {filter_field} > {filter_value}", "LIMIT {limit}"],
            "local": ["extra.csv", "missing.csv"],
        },
    }
    sources = {"series": series_source(points), "relational": sql_source(), "local": file_source([str(tmp_path)])}
    return entry, sources


def test_fused_plan(spark, demo):
    entry, sources = demo
    out = run_plan(spark, entry, sources)
    assert out.count() == 48 + 10 + 1
    assert {"bucket", "_field", "n", "level", "note"} <= set(out.columns)
    with pytest.raises(ValueError, match="time column"):  # SQL and files without one cannot take a range
        run_plan(spark, entry, sources, stop="2025-06-01T00:07:00Z")
    with pytest.raises(ValueError):
        run_plan(spark, entry, {"series": sources["series"]})


def test_sql_source_takes_a_range(spark):
    spark.createDataFrame([(T0,), (T0 + timedelta(days=1),)], "t timestamp").createOrReplaceTempView("timed")
    load = sql_source(time="t")
    assert load(spark, "SELECT * FROM timed", {}, None, None).count() == 2
    assert load(spark, "SELECT * FROM timed", {}, None, STOP).count() == 1
    assert load(spark, "SELECT * FROM timed", {}, STOP, None).count() == 1


def test_parameters_fill_whole_arguments():
    query = [{"range": {"start": "{time_start}", "stop": "{time_now}"}}, {"bucket": ["{b}", "x{b}"]}]
    filled = fill_parameters(query, {"time_start": 0, "time_now": 60, "b": "b0"})
    assert filled == [{"range": {"start": 0, "stop": 60}}, {"bucket": ["b0", "xb0"]}]


class Doubled(Described, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset):
        return dataset.withColumn("doubled", F.col("_value") * 2)

    def results(self, df):
        return {"doubled": df.select("doubled")}


class FirstOnly(Fuse):
    def fuse(self, frames):
        return next(iter(frames.values()))


def test_fit_save_load_predict(spark, points, tmp_path):
    pipe, predicted = pipes.fit_predict("p", Pipeline(stages=[Centre()]), points, {"series": {"buckets": ["b0"]}})
    path = str(tmp_path / "pipe")
    pipes.save_pipe(spark, pipe, path)
    pipes.save_pipe(spark, pipe, path)
    loaded = pipes.load_pipe(spark, path)
    assert (loaded.name, loaded.training_info, loaded.date) == (pipe.name, pipe.training_info, pipe.date)
    assert loaded.predict(points).exceptAll(predicted).count() == 0
    assert list(loaded.results(points)[0]) == ["learned"]
    ranged = pipes.predict_range(spark, loaded, {"series": series_source(points)}, None, None)
    assert {r[0] for r in ranged.select("bucket").distinct().collect()} == {"b0"}


def test_user_stages(spark, points):
    pipes.register(Doubled)
    pipes.register(FirstOnly)
    plan = {
        "one": {
            "steps": {"demo.FirstOnly": {}, "demo.Doubled": {}, "Centre": {"keys": ["bucket", "_field"]}},
            "data_sources": {"series": {"buckets": ["b0", "b1"]}},
        },
        "nothing": {"steps": {"Doubled": {}}, "data_sources": {"series": {"buckets": ["absent"]}}},
    }
    fitted = pipes.fit_plans(spark, plan, {"series": series_source(points)})
    assert list(fitted) == ["one"]
    row = fitted["one"].predict(points.where("bucket = 'b1' AND _field = 'f1'")).orderBy("_time").collect()[1]
    assert (row.doubled, row.prediction, row.residual) == (4.0, 11.0, -9.0)
    results = fitted["one"].results(points)
    assert [list(r) for r in results] == [[], ["doubled"], ["learned"]]
    with pytest.raises(ValueError):
        pipes.make_stage("Unknown", {})


def test_no_rows_is_an_error(points):
    with pytest.raises(pipes.InsufficientData):
        pipes.fit_pipe("p", Pipeline(stages=[Centre()]), points.limit(0))


def test_update_and_describe_stages(points):
    pipe = pipes.fit_pipe("p", Pipeline(stages=[Synchronise(fields=["f1"], keys=["bucket", "floor"]), Centre(inputCol="f1")]), points)
    with pytest.warns(UserWarning):
        pipe.update(fillLimit=5)
    assert any(a.get("fillLimit") == 5 for a in pipe.attributes().values())
    assert len(pipe.info()) == 2


class Labelled(Doubled):
    label = "twice"
    bounds = (0, 10)


def test_stages_show_what_they_are(points):
    pipe = pipes.fit_pipe("p", Pipeline(stages=[Labelled(), Centre(keys=["bucket"])]), points)
    first, second = pipe.model.stages
    shown = pipe.attributes()
    assert shown[first.uid] == {"label": "twice", "bounds": (0, 10)}
    assert shown[second.uid]["keys"] == ["bucket"]
    assert pipe.files()[first.uid].endswith("test_plans.py") and pipe.files()[second.uid].endswith("stages.py")
    columns, rows = pipe.matrices(points)[second.uid]["learned"]
    assert rows == points.select("bucket").distinct().count() and "std" in columns


def test_stages_without_updates_warn(points):
    pipe = pipes.Pipe("p", Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__")]).fit(points))
    with pytest.warns(UserWarning, match="no updates"):
        pipe.update(fillLimit=1)
    with pytest.raises(TypeError):
        pipe.predict_proba(points)


def test_centre_statistics(spark, points):
    model = Centre(keys=["bucket"]).fit(points)
    ours = {r.bucket: (r.mean, r.std) for r in moments(model.stats).collect()}
    theirs = points.groupBy("bucket").agg(F.avg("_value").alias("m"), F.stddev_samp("_value").alias("s")).collect()
    for r in theirs:
        assert ours[r.bucket] == (pytest.approx(r.m), pytest.approx(r.s))


def test_partial_fit_adds_up(points):
    halves = [points.where("_time < '2025-06-01 00:30:00'"), points.where("_time >= '2025-06-01 00:30:00'")]
    grown = Centre().fit(halves[0]).partial_fit(halves[1])
    assert isinstance(grown, CentreModel)
    for ours, theirs in zip(sorted(grown.stats.collect()), sorted(Centre().fit(points).stats.collect())):
        assert ours[:2] == theirs[:2] and ours[2:] == pytest.approx(theirs[2:])


def test_deviation_of_large_values(spark):
    df = spark.createDataFrame([("a", 1e9 + i % 3) for i in range(300)] + [("b", None)], "bucket string, _value double")
    whole = Centre().fit(df)
    parts = Centre().fit(df.limit(0)).partial_fit(df.where("_value < 1e9 + 1")).partial_fit(df.where("_value is null or _value >= 1e9 + 1"))
    for model in (whole, parts):
        out = {r.bucket: (r.n, r["mean"], r["std"]) for r in moments(model.stats).collect()}
        assert out["a"] == (300, 1e9 + 1, pytest.approx(np.std([0, 1, 2] * 100, ddof=1), rel=1e-7)) and out["b"] == (0, None, None)


def test_prediction_outlives_the_training_files(spark, tmp_path):
    path = str(tmp_path / "train")
    spark.createDataFrame([("a", 1.0), ("a", 3.0)], "bucket string, _value double").write.parquet(path)
    model = Centre().fit(spark.read.parquet(path))
    spark.createDataFrame([("a", 100.0)], "bucket string, _value double").write.mode("overwrite").parquet(path)
    row = model.predict_proba(spark.read.parquet(path)).collect()[0]
    assert (row.prediction, row.residual) == (2.0, 98.0) and 0 <= row.probability < 1e-6
    near = model.predict_proba(spark.createDataFrame([("a", 2.0), ("a", 2.0 + 2**0.5)], "bucket string, _value double")).collect()
    assert [r.probability for r in near] == [pytest.approx(1.0, abs=1e-6), pytest.approx(0.3173105, abs=1e-6)]
    model.release()
    assert model.transform(spark.read.parquet(path)).count() == 1


class Hundredfold(Fuse):
    def fuse(self, frames):
        return super().fuse(frames).withColumn("_value", F.col("_value") * 100)


def test_prediction_prepares_data_as_training_does(spark, points, tmp_path):
    """Parameters stay filled in and the chain's own fusing stage is used, after saving and loading too."""
    pipes.register(Hundredfold)
    points.createOrReplaceTempView("all_points")
    plan = {
        "p": {
            "steps": {"Hundredfold": {"series": {"b": "b0"}, "sql": {"name": "b1", "low": 0.0}}, "Centre": {"keys": ["bucket"]}},
            "data_sources": {
                "series": {"buckets": ["{b}"]},
                "sql": ["SELECT * FROM all_points", "WHERE bucket = '{name}' AND _value >= {low}"],
            },
        }
    }
    sources = {"series": series_source(points), "sql": sql_source()}
    path = str(tmp_path / "pipe")
    pipes.save_pipe(spark, pipes.fit_plans(spark, plan, sources)["p"], path)
    loaded = pipes.load_pipe(spark, path)
    everything = pipes.predict_range(spark, loaded, sources, None, None)
    assert {r[0] for r in everything.select("bucket").distinct().collect()} == {"b0", "b1"}
    worst = everything.groupBy("bucket").agg(F.abs(F.avg("residual")).alias("r")).collect()
    assert max(r.r for r in worst) < 1e-6
    one = pipes.predict_range(spark, loaded, sources, None, None, source="sql")
    assert {r[0] for r in one.select("bucket").distinct().collect()} == {"b1"}
    assert loaded.model.stages[0].getOrDefault("parameters")["series"] == {"b": "b0"}
    with pytest.raises(ValueError):
        pipes.predict_range(spark, loaded, sources, None, None, source="absent")
    late = pipes.predict_range(spark, loaded, sources, "2025-06-01T00:05:00Z", None)
    assert 0 < late.count() < everything.count()


def test_a_query_without_a_range_takes_one(points):
    load = series_source(points)
    whole = load(points.sparkSession, {"buckets": ["b0"]}, {}, None, None).count()
    assert 0 < load(points.sparkSession, {"buckets": ["b0"]}, {}, "2025-06-01T00:05:00Z", None).count() < whole


def test_whole_groups_reach_a_pandas_model(spark):
    """Ranks over a group of more rows than an Arrow batch holds."""
    df = spark.range(25_000).selectExpr("cast(id % 2 as string) as bucket", "cast(id as double) as _value")

    def ranked(key, rows):
        return rows.assign(rank=rows["_value"].rank().astype("int64"))[["bucket", "rank"]]

    out = predict_groups(df, ranked, "bucket string, rank long", ["bucket"])
    assert sorted(tuple(r) for r in out.groupBy("bucket").agg(F.max("rank"), F.countDistinct("rank")).collect()) == [("0", 12_500, 12_500), ("1", 12_500, 12_500)]


def test_null_group_is_predicted(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "bucket string, _value double")
    out = Centre().fit(df).transform(df).collect()
    assert sorted(r.prediction for r in out) == [2.0, 2.0, 5.0]


def test_pandas_model_sees_one_bucket_at_a_time(points):
    def predict(bucket, rows):
        assert (rows["bucket"] == bucket).all()
        return rows[["bucket", "_value"]].assign(twice=rows["_value"] * 2)

    out = predict_rows_per_bucket(points, predict, "bucket string, _value double, twice double")
    assert out.count() == points.count()
    assert out.where("twice <> 2 * _value").count() == 0


def test_range_goes_under_the_query(spark):
    """A new range cuts the tables a query reads, not what its limit leaves."""
    rows = [(i, datetime(1960 + i, 1, 1), "ab"[i % 2]) for i in range(60)]
    spark.createDataFrame(rows, "n int, t timestamp, k string").createOrReplaceTempView("ranged_rows")
    load = sql_source(time="t")
    first = load(spark, "SELECT n FROM ranged_rows ORDER BY n LIMIT 3", {}, "1980-01-01", "1990-01-01")
    assert [r.n for r in first.collect()] == [20, 21, 22]
    text = ["WITH some AS (SELECT * FROM {table} WHERE k = {k})", "SELECT k, count(*) AS c, min(n) AS low FROM some GROUP BY k"]
    found = load(spark, {"sql": text, "params": {"table": "ranged_rows", "k": "a"}}, {}, None, "1990-01-01").collect()
    assert [tuple(r) for r in found] == [("a", 15, 0)]  # those before 1970 too
    assert load(spark, "SELECT n FROM ranged_rows", {}, "1980-01-01", None).count() == 40
    with pytest.raises(ValueError):
        sql_source(time="absent")(spark, "SELECT n FROM ranged_rows LIMIT 3", {}, "1980-01-01", None)


def test_stop_alone_keeps_what_lies_before_1970(spark):
    rows = [("b", datetime(1960, 1, 1), 1.0), ("b", datetime(2025, 1, 1), 2.0), ("b", datetime(2026, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "bucket string, _time timestamp, _value double")
    for query in ([{"bucket": ["b"]}], {"range": {"start": None, "stop": "2024-01-01"}}):
        assert run_query(df, query, stop="2025-06-01").count() == 2
    assert run_query(df, [{"bucket": ["b"]}], start="1961-01-01").count() == 2
