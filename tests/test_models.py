"""A model per group: fitted in one job, saved, loaded, equal to a loop over the groups."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from chronoloom.operators.regression import coefficients, gram_sums, merged_sums
from chronoloom.plans.models import GroupModels, GroupRegression, GroupRegressionModel, MedianBand, fit_groups, model_class, predict_with
from chronoloom.plans.pipes import build_pipeline, fit_pipe, load_pipe, save_pipe
from chronoloom.plans.stages import slot_of

T0 = datetime(2025, 6, 1)
SCHEMA = "bucket string, _field string, _time timestamp, _value double, x double, z double"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for k, (bucket, field, n) in enumerate([("b0", "t", 200), ("b0", "h", 50), ("b1", "t", 3), (None, "t", 40), ("b2", "t", 1)]):
        x, z = rng.normal(size=n), rng.normal(size=n) + 1e6
        y = k + 2.0 * x - 0.5 * (z - 1e6) + 0.01 * rng.normal(size=n)
        out += [(bucket, field, T0 + timedelta(hours=6 * i), float(y[i]) if i % 9 else None, float(x[i]), float(z[i])) for i in range(n)]
    return out


def groups(rows):
    frame = pd.DataFrame(rows, columns=["bucket", "_field", "_time", "_value", "x", "z"])
    return {tuple(None if pd.isna(k) else k for k in key): own for key, own in frame.groupby(["bucket", "_field"], dropna=False)}


def test_one_job_equals_a_loop(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stage = GroupModels(model="MedianBand", keys=["bucket", "_field"], columns=["_value"], slot="1 day")
    save_pipe(spark, fit_pipe("bands", Pipeline(stages=[stage]), df), str(tmp_path / "pipe"))
    pipe = load_pipe(spark, str(tmp_path / "pipe"))
    made = {(r["bucket"], r["_field"], r["_time"]): r for r in pipe.predict(df).collect()}
    assert len(made) == len(rows)
    learned = {(r["bucket"], r["_field"]): r for r in pipe.results(df)[0]["models"].collect()}
    for key, own in groups(rows).items():
        wanted = MedianBand.fit(own)
        assert learned[key]["n"] == len(own)
        if wanted is None:
            assert learned[key]["parameters"] is None
            continue
        assert json.loads(learned[key]["parameters"]) == pytest.approx(wanted)
        for row in MedianBand.predict(wanted, own).itertuples():
            got = made[(*key, row._3.to_pydatetime() if hasattr(row._3, "to_pydatetime") else row._3)]
            assert got["prediction"] == pytest.approx(row.prediction)
            assert got["score"] == (None if pd.isna(row.score) else pytest.approx(row.score))
            assert got["alarm"] == (None if pd.isna(row.score) else row.alarm)


def test_slots_share_a_model_and_unknown_groups_get_nulls(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    keys = ["bucket", "_field"]
    table = fit_groups(df.where("_field = 't'"), MedianBand.fit, keys, ["_value"])
    plain = predict_with(df, table, MedianBand.predict, MedianBand.OUTPUT, keys).collect()
    cut = predict_with(df, table, MedianBand.predict, MedianBand.OUTPUT, keys, slot_of(width="12 hours")).collect()
    assert sorted(map(str, plain)) == sorted(map(str, cut)) and len(cut) == len(rows)
    assert all(r["prediction"] is None and r["alarm"] is None for r in cut if r["_field"] == "h")
    assert predict_with(df.limit(0), table, MedianBand.predict, MedianBand.OUTPUT, keys).collect() == []
    assert fit_groups(df.limit(0), MedianBand.fit, keys, ["_value"]).collect() == []


def test_models_by_name():
    assert model_class("chronoloom.plans.models.MedianBand") is MedianBand
    with pytest.raises(ValueError):
        model_class("Unheard")


def least_squares(own, features):
    own = own.dropna(subset=["_value", *features])
    x = own[features].to_numpy()
    y = own["_value"].to_numpy()
    slopes, *_ = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=None)
    return slopes, y.mean() - slopes @ x.mean(axis=0)


def test_regression_equals_numpy(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    keys, features = ["bucket", "_field"], ["x", "z"]
    found = {(r["bucket"], r["_field"]): r for r in coefficients(gram_sums(df, keys, features, "_value"), keys, features).collect()}
    for key, own in groups(rows).items():
        if own["_value"].notna().sum() < 4:  # more unknowns than rows
            continue
        slopes, intercept = least_squares(own, features)
        assert found[key]["coefficients"] == pytest.approx(slopes, rel=1e-6)
        assert found[key]["intercept"] == pytest.approx(intercept, rel=1e-6)
        assert found[key]["r2"] > 0.99
    assert ("b2", "t") not in found  # its only label is missing


def test_batches_add_up_to_one_fit(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    keys, features = ["bucket", "_field"], ["x", "z"]
    parts = [df.where((F.unix_seconds("_time") / 21600) % 3 == i) for i in range(3)]
    merged = merged_sums(gram_sums(parts[0], keys, features, "_value").union(gram_sums(parts[1], keys, features, "_value")).union(gram_sums(parts[2], keys, features, "_value")), keys, features)
    at_once = {(r["bucket"], r["_field"]): r for r in gram_sums(df, keys, features, "_value").collect()}
    for r in merged.collect():
        assert tuple(r)[2:] == pytest.approx(tuple(at_once[(r["bucket"], r["_field"])])[2:], rel=1e-6, abs=1e-6)
    model = GroupRegression(features=features, keys=keys).fit(parts[0])
    for part in parts[1:]:
        model = model.partial_fit(part)
    model.write().session(spark).overwrite().save(str(tmp_path / "m"))
    model = GroupRegressionModel.load(str(tmp_path / "m"))
    whole = GroupRegression(features=features, keys=keys).fit(df)
    ours, theirs = (sorted(((str(r["bucket"]), r["_field"], r["_time"], r["prediction"]) for r in m.transform(df).collect())) for m in (model, whole))
    for a, b in zip(ours, theirs):
        assert a[:3] == b[:3] and (a[3] == b[3] or a[3] == pytest.approx(b[3], rel=1e-5))


def test_dependent_features_take_the_least_norm(spark):
    df = spark.createDataFrame([("k", float(i), 2.0 * i, 3.0 * i + 1) for i in range(10)], "bucket string, x double, z double, _value double")
    row = coefficients(gram_sums(df, ["bucket"], ["x", "z"], "_value"), ["bucket"], ["x", "z"]).first()
    assert row["coefficients"] == pytest.approx([1.5, 0.75]) and row["intercept"] == pytest.approx(1.0)
    flat = spark.createDataFrame([("k", 1.0, 5.0)] * 3, "bucket string, x double, _value double")
    row = coefficients(gram_sums(flat, ["bucket"], ["x"], "_value"), ["bucket"], ["x"]).first()
    assert (row["intercept"], row["coefficients"], row["r2"] is None or row["r2"] != row["r2"]) == (5.0, [0.0], True)


def test_plans_name_group_stages(spark, rows):
    pipeline = build_pipeline({"GroupModels": {"model": "MedianBand", "keys": ["bucket"]}, "GroupRegression": {"features": ["x"], "keys": ["bucket"]}})
    df = spark.createDataFrame(rows, SCHEMA)
    first, second = pipeline.getStages()
    assert first.fit(df).stats.count() == 4
    assert second.fit(df).transform(df).where("prediction IS NOT NULL").count() > 200
