from __future__ import annotations

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.operators.sync import complete_grid, on_grid, synchronise
from chronoloom.plans.stages import Centre, CentreModel, sufficient_statistics
from chronoloom.streaming.fill import disk_state, stream_filled
from chronoloom.streaming.learn import latest_model, predict_and_partial_fit, predictions
from chronoloom.streaming.points import read_stream, run_available, stream_grid, stream_windows, streamed_table
from chronoloom.workload import queries

T0 = datetime(2025, 6, 1)
SCHEMA = "_time timestamp, system_id string, floor string, equipment_number string, _field string, _value double"
KEYS = ["system_id", "floor", "equipment_number"]


@pytest.fixture
def arriving(spark, tmp_path):
    """Three files, readings up to five minutes late and out of order, twins at some instants."""
    rng = np.random.default_rng(3)
    folder = str(tmp_path / "in")
    base, rows = 0.0, []
    for _ in range(900):
        base += float(rng.integers(1, 40))
        late = float(rng.integers(0, 300))
        rows.append(
            (T0 + timedelta(seconds=max(0.0, base - late)), str(rng.integers(3)), "f", str(rng.integers(2)),
             str(rng.choice(["a", "b"])), float(rng.integers(100)))
        )
        if len(rows) % 50 == 0:
            rows.append((*rows[-1][:-1], rows[-1][-1] + 1.0))
    for part in range(3):
        chunk = rows[part * len(rows) // 3 : (part + 1) * len(rows) // 3]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.createDataFrame(rows, SCHEMA)


def test_grid_equals_batch_on_closed_steps(spark, arriving, tmp_path):
    folder, batch = arriving
    stream = read_stream(spark, folder, batch.schema, files_per_batch=1)
    run_available(stream_grid(stream, ["a", "b"], KEYS, delay="10m"), str(tmp_path / "out"))
    streamed = streamed_table(spark, str(tmp_path / "out"))
    closed = batch.agg(F.max("_time")).collect()[0][0] - timedelta(minutes=10)
    wanted = on_grid(batch, ["a", "b"], KEYS).where(F.timestamp_seconds(F.col("_time") + 120) < F.lit(closed))
    assert streamed.count() == wanted.count() > 100
    ours = {tuple(r[:4]): r[4:] for r in streamed.collect()}
    for r in wanted.collect():
        assert ours[tuple(r[:4])] == pytest.approx(r[4:], nan_ok=True) or None in r[4:]
    filled = complete_grid(streamed, ["a", "b"], KEYS)
    assert 0 < filled.count() <= synchronise(batch, ["a", "b"], KEYS).count()


def test_windows_close_with_the_watermark(spark, arriving, tmp_path):
    folder, batch = arriving
    stream = read_stream(spark, folder, batch.schema, files_per_batch=1)
    run_available(stream_windows(stream, "30m", "max", ["system_id"], "10m"), str(tmp_path / "out"))
    streamed = streamed_table(spark, str(tmp_path / "out"))
    closed = batch.agg(F.max("_time")).collect()[0][0] - timedelta(minutes=10)
    wanted = (
        batch.groupBy(F.window("_time", "30 minutes").alias("w"), "system_id")
        .agg(F.max("_value").alias("v"))
        .where(F.col("w.end") <= F.lit(closed))
        .select("system_id", "w.end", "v")
    )
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_second_run_goes_on_where_the_first_ended(spark, arriving, tmp_path):
    folder, batch = arriving
    out = str(tmp_path / "out")
    for _ in range(2):
        stream = read_stream(spark, folder, batch.schema)
        run_available(stream_windows(stream, "30m", "sum", ["system_id"], "10m"), out)
    table = streamed_table(spark, out)
    assert table.count() == table.select("system_id", "_time").distinct().count()


@pytest.mark.parametrize("step", ["2m", "10m", "90s"])
def test_grid_of_any_step(spark, arriving, tmp_path, step):
    """Even steps and steps of seconds, whose ties go to the even multiple."""
    folder, batch = arriving
    stream = read_stream(spark, folder, batch.schema, files_per_batch=1)
    run_available(stream_grid(stream, ["a", "b"], KEYS, step, "10m"), str(tmp_path / "out"))
    whole = on_grid(batch, ["a", "b"], KEYS, step)
    closed = whole.agg(F.max("_time")).collect()[0][0] - 600
    wanted = whole.where(F.col("_time") <= closed)
    streamed = streamed_table(spark, str(tmp_path / "out")).collect()
    assert sorted(map(str, streamed)) == sorted(map(str, wanted.collect())) and len(streamed) > 50


@pytest.mark.parametrize("scope, limit", [("system", 2), ("series", 2), ("system", 0), ("series", 3)])
def test_fill_as_the_grid_closes(spark, arriving, tmp_path, scope, limit):
    """Batch by batch the same rows as one fill of the whole grid, each once."""
    folder, batch = arriving
    rows = read_stream(spark, folder, batch.schema, files_per_batch=1)
    with disk_state(spark):
        run_available(stream_filled(stream_grid(rows, ["a", "b"], KEYS, "2m"), ["a", "b"], KEYS, limit, scope), str(tmp_path / "filled"))
    run_available(stream_grid(read_stream(spark, folder, batch.schema), ["a", "b"], KEYS, "2m"), str(tmp_path / "grid"))
    wanted = complete_grid(streamed_table(spark, str(tmp_path / "grid")), ["a", "b"], KEYS, limit, scope)
    ours = streamed_table(spark, str(tmp_path / "filled")).collect()
    assert sorted(map(tuple, ours)) == sorted(map(tuple, wanted.collect())) and len(ours) > 100


def test_silent_series_end(spark, tmp_path):
    """A timer gives out the waiting rows of a series that stays silent, and drops its state."""
    steps = [(T0 + timedelta(minutes=5 * i), "live", "f", "1", "a", float(i)) for i in range(40)]
    gone = [(T0 + timedelta(minutes=5 * i), "gone", "f", "1", f, 1.0) for i, f in enumerate("ab")]
    back = [(T0 + timedelta(minutes=5 * 35), "gone", "f", "1", "b", 7.0)]
    folder = str(tmp_path / "in")
    live = lambda low, high: [(*r[:4], f, r[5]) for r in steps[low:high] for f in "ab"]
    for rows in (gone + live(0, 3), live(3, 20), live(20, 36) + back, live(36, 40)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    grid = stream_grid(read_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1), ["a", "b"], KEYS, "10s", "5m")
    with disk_state(spark):
        out = stream_filled(grid, ["a", "b"], KEYS, 1, "series", patience="30m", incomplete=True)
        run_available(out, str(tmp_path / "out"))
    made = streamed_table(spark, str(tmp_path / "out"))
    start = int((T0 - datetime(1970, 1, 1)).total_seconds())
    ours = sorted((r["_time"] - start, r["a"], r["b"]) for r in made.where("system_id = 'gone'").collect())
    # The last row waits for a later one to fill its missing ``a``, which the row before gives; nothing gives the first its ``b`` but the second.
    assert ours == [(0, 1.0, 1.0), (300, 1.0, 1.0)]
    assert made.where("system_id = 'live'").count() == made.where("system_id = 'live'").distinct().count() >= 35


@pytest.mark.parametrize("scope, limit, shares", [("series", 1, 3), ("series", 2, 1), ("system", 2, 2)])
def test_many_series_are_filled_in_shares(spark, tmp_path, scope, limit, shares):
    """The state has a key for each share and not for each series; a share's series, some of them without a floor, are filled apart."""
    rng = np.random.default_rng(5)
    folder, rows = str(tmp_path / "in"), []
    for i in range(3000):
        unit = int(rng.integers(60))
        at = T0 + timedelta(seconds=i * 12 + int(rng.integers(100)))
        rows.append((at, str(unit % 7), None if unit % 3 else "f", str(unit), str(rng.choice(["a", "b"])), float(rng.integers(100))))
    for part in range(3):
        spark.createDataFrame(rows[part * 1000 : (part + 1) * 1000], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    batch = spark.createDataFrame(rows, SCHEMA).fillna("none", "floor")
    stream = lambda: stream_grid(read_stream(spark, folder, batch.schema, files_per_batch=1).fillna("none", "floor"), ["a", "b"], KEYS)
    unnamed = stream().withColumn("floor", F.nullif("floor", F.lit("none")))
    with disk_state(spark):
        run_available(stream_filled(unnamed, ["a", "b"], KEYS, limit, scope, shares=shares), str(tmp_path / "filled"))
    run_available(stream(), str(tmp_path / "grid"))
    wanted = complete_grid(streamed_table(spark, str(tmp_path / "grid")), ["a", "b"], KEYS, limit, scope).collect()
    ours = streamed_table(spark, str(tmp_path / "filled")).fillna("none", "floor").collect()
    assert sorted(map(tuple, ours)) == sorted(map(tuple, wanted)) and len(ours) > 100
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "held").load(str(tmp_path / "filled" / "checkpoint"))
    assert 0 < state.select("key").distinct().count() <= shares


def test_a_share_ends_its_silent_series(spark, tmp_path):
    """A series ends although others of its share go on: their rows replace the share's timer in every batch."""
    folder = str(tmp_path / "in")
    live = lambda low, high: [(T0 + timedelta(minutes=5 * i), "s", "f", "live", f, float(i)) for i in range(low, high) for f in "ab"]
    gone = [(T0 + timedelta(minutes=5 * i), "s", "f", "gone", f, 1.0) for i, f in enumerate("ab")]
    for rows in (gone + live(0, 3), live(3, 20), live(20, 36), live(36, 50), live(50, 60)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    grid = stream_grid(read_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1), ["a", "b"], KEYS, "10s", "5m")
    with disk_state(spark):
        out = stream_filled(grid, ["a", "b"], KEYS, 1, "series", patience="30m", incomplete=True, shares=1)
        run_available(out, str(tmp_path / "out"))
    made = streamed_table(spark, str(tmp_path / "out"))
    start = int((T0 - datetime(1970, 1, 1)).total_seconds())
    ours = sorted((r["_time"] - start, r["a"], r["b"]) for r in made.where("equipment_number = 'gone'").collect())
    assert ours == [(0, 1.0, 1.0), (300, 1.0, 1.0)]
    live_rows = sorted(r["_time"] - start for r in made.where("equipment_number = 'live'").collect())
    assert live_rows == [300 * i for i in range(len(live_rows))] and len(live_rows) >= 55


def test_incomplete_rows_on_request(spark, tmp_path):
    """With the timer a row without a partner is given out as it is, once its series has ended."""
    folder = str(tmp_path / "in")
    rows = [(T0, "x", "f", "1", "a", 1.0)], [(T0 + timedelta(minutes=5 * i), "y", "f", "1", f, 2.0) for i in range(30) for f in "ab"]
    for part in (*rows, [(T0 + timedelta(hours=5), "y", "f", "1", "a", 3.0)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    grid = stream_grid(read_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1), ["a", "b"], KEYS, "10s", "5m")
    with disk_state(spark):
        run_available(stream_filled(grid, ["a", "b"], KEYS, patience="30m", incomplete=True), str(tmp_path / "out"))
    made = streamed_table(spark, str(tmp_path / "out")).where("system_id = 'x'").collect()
    assert [(r["a"], r["b"]) for r in made] == [(1.0, None)]
    with pytest.raises(ValueError):
        stream_filled(grid, ["a", "b"], KEYS, fill_scope="house")


def test_a_large_file_arrives_in_many(spark, sf_dir):
    """Weeks are written and read by as many tasks as Spark reads the events with, be they one file."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        read_by = spark.read.parquet(f"{sf_dir}/events.parquet").rdd.getNumPartitions()
        path, files_a_week = queries._arriving(spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files_a_week == read_by > 2
    arrived = spark.read.parquet(path)
    assert len(arrived.inputFiles()) == len(queries.WEEKS) * files_a_week  # every batch is a week
    assert sorted(map(tuple, arrived.collect())) == sorted(map(tuple, spark.read.parquet(f"{sf_dir}/events.parquet").collect()))


def empty_model(batch):
    model = CentreModel(sufficient_statistics(batch.limit(0), ["system_id"]))
    model.update(keys=["system_id"])
    return model


def test_predict_and_learn(spark, arriving, tmp_path):
    folder, batch = arriving
    path, start = str(tmp_path / "model"), empty_model(batch)
    predict_and_partial_fit(read_stream(spark, folder, batch.schema, files_per_batch=1), start, path)
    learned = latest_model(spark, start, path).stats
    whole = sufficient_statistics(batch, ["system_id"]).select(learned.columns)
    for ours, theirs in zip(sorted(learned.collect()), sorted(whole.collect())):
        assert ours[:2] == theirs[:2] and ours[2:] == pytest.approx(theirs[2:])
    made = predictions(spark, path)
    assert made.count() == batch.count()
    # Nothing was known when the first batch was predicted, everything before it when a later one was.
    assert made.where("batch = 0 AND prediction IS NOT NULL").count() == 0
    assert made.where("batch > 0 AND prediction IS NULL").count() == 0
    assert len(os.listdir(os.path.join(path, "models"))) == 3


def test_old_versions_can_go(spark, arriving, tmp_path):
    folder, batch = arriving
    path, start = str(tmp_path / "model"), empty_model(batch)
    with pytest.raises(ValueError):
        predict_and_partial_fit(read_stream(spark, folder, batch.schema), start, path, keep=1)
    predict_and_partial_fit(read_stream(spark, folder, batch.schema, files_per_batch=1), start, path, keep=2)
    assert len(os.listdir(os.path.join(path, "models"))) == 2
    assert latest_model(spark, start, path).stats.agg(F.sum("n")).collect()[0][0] == batch.count()


def test_a_batch_sees_only_versions_before_it(spark, arriving, tmp_path):
    folder, batch = arriving
    path, start = str(tmp_path / "model"), empty_model(batch)
    predict_and_partial_fit(read_stream(spark, folder, batch.schema, files_per_batch=1), start, path)
    assert latest_model(spark, start, path, before=0) is start
    seen = [latest_model(spark, start, path, before=n).stats.agg(F.sum("n")).collect()[0][0] for n in (1, 2, 3)]
    assert seen[0] < seen[1] < seen[2] == batch.count()


class OnlyPredicts(CentreModel):
    partial_fit = property()


def test_models_that_cannot_learn_only_predict(spark, arriving, tmp_path):
    folder, batch = arriving
    fitted = Centre(keys=["system_id"]).fit(batch)
    fixed = OnlyPredicts(fitted.stats)
    fixed.update(keys=["system_id"])
    path = str(tmp_path / "fixed")
    predict_and_partial_fit(read_stream(spark, folder, batch.schema), fixed, path)
    assert predictions(spark, path).where("prediction IS NULL").count() == 0
    assert not os.path.exists(os.path.join(path, "models"))
