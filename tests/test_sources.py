from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import check_identifier
from chronoloom.operators import select
from chronoloom.sources import annotated, catalogue, files, relational, series_table
from chronoloom.sources.generate import DEMO_TAGS, clock, sensor_rows

T0 = datetime(2025, 6, 1)
START, END = "2025-06-01T00:00:00Z", "2025-06-08T00:00:00Z"


def test_generator_follows_its_schema(spark):
    df = sensor_rows(clock(spark, START, END)).cache()
    assert df.count() == 10080
    bounds = df.agg({"_time": "max", "field_11": "max", "field_12": "min"}).collect()[0]
    assert bounds["max(_time)"] == datetime(2025, 6, 7, 23, 59)
    assert 0 <= bounds["min(field_12)"] and bounds["max(field_11)"] <= 1000
    assert df.where("_measurement = 'measurement_1' AND (field_11 IS NULL OR field_21 IS NOT NULL)").count() == 0
    assert df.where("_measurement = 'measurement_2' AND (field_22 IS NULL OR field_13 IS NOT NULL)").count() == 0
    assert df.where("NOT field_13 RLIKE '^[a-z]{5,10}$'").count() == 0
    assert {r[0] for r in df.select("tag_1").distinct().collect()} == set(DEMO_TAGS["tag_1"])
    share = df.where("_measurement = 'measurement_1'").count() / 10080
    assert 0.45 < share < 0.55
    df.unpersist()


def test_generator_repeats_whatever_the_partitioning(spark):
    times = clock(spark, START, "2025-06-01T06:00:00Z")
    one, many = sensor_rows(times.coalesce(1)), sensor_rows(times.repartition(7))
    assert one.exceptAll(many).count() == 0
    assert one.exceptAll(sensor_rows(times, seed=1)).count() > 0


def test_annotated_csv(spark, tmp_path):
    path = str(tmp_path / "annotated")
    rows = [("m", "t,1", T0, 1.5, 'say "hi", ok', True, None), ("m", None, T0 + timedelta(milliseconds=5), None, None, False, 7)]
    df = spark.createDataFrame(rows, "_measurement string, tag string, _time timestamp, d double, s string, b boolean, n long")
    annotated.write_annotated_csv(df.coalesce(1), path, ["tag"], ["n", "d", "s", "b"])
    part = next(f for f in os.listdir(path) if f.startswith("part"))
    head = open(os.path.join(path, part)).read().splitlines()[:5]
    assert head == [
        "#datatype,measurement,tag,dateTime:RFC3339,boolean,double,long,string",
        "#group,false,true,false,false,false,false,false",
        "#default,,,,,,,",
        ",_measurement,tag,_time,b,d,n,s",
        ',m,"t,1",2025-06-01T00:00:00.000Z,True,1.5,,"say ""hi"", ok"',
    ]
    back = annotated.read_annotated_csv(spark, path)
    assert [f.dataType for f in back.schema][3:] == [T.BooleanType(), T.DoubleType(), T.LongType(), T.StringType()]
    assert back.select(df.columns).exceptAll(df).count() == 0 and back.count() == 2


def test_demo_cycle(spark, tmp_path):
    """Generate, write annotated, read back, copy to CSV, upload as points, scan a range."""
    df = sensor_rows(clock(spark, START, END))
    fields = ["field_11", "field_12", "field_13", "field_21", "field_22"]
    annotated.write_annotated_csv(df, str(tmp_path / "a"), list(DEMO_TAGS), fields)
    back = annotated.read_annotated_csv(spark, str(tmp_path / "a"))
    assert back.exceptAll(df).count() == 0 and back.count() == 10080
    files.write_csv(back, str(tmp_path / "copy.csv"))
    assert files.read_any(spark, str(tmp_path / "copy.csv")).count() == 10080
    series_table.upload_wide(back, str(tmp_path / "points"), "demo", list(DEMO_TAGS), fields)
    points = series_table.scan_points(spark, str(tmp_path / "points"), ["demo"], START, "2025-06-04T00:00:00Z")
    wanted = df.where("_measurement = 'measurement_1' AND _time < '2025-06-04'").count()
    chosen = points.where("_measurement = 'measurement_1' AND _field IN ('field_12', 'field_13')")
    assert chosen.count() == 2 * wanted
    assert chosen.where("_field = 'field_13' AND _value_text IS NULL").count() == 0


def test_bucket_names_stay_text(spark, tmp_path):
    rows = [("007", "1", T0, "f", 1.0), ("8", "2", T0, "f", 2.0)]
    df = spark.createDataFrame(rows, "bucket string, _measurement string, _time timestamp, _field string, _value double")
    path = str(tmp_path / "p")
    series_table.write_points(df, path)
    assert [r.bucket for r in series_table.scan_points(spark, path, "007").collect()] == ["007"]
    series_table.write_points(df, path)
    assert series_table.scan_points(spark, path).count() == 4


def test_json_arrays_and_lines(spark, tmp_path):
    rows = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    for name in ("array.json", "lines.json"):
        out = files.read_any(spark, str(tmp_path / name))
        assert sorted((r.a, r.b) for r in out.collect()) == [(1, "x"), (2, None)]


def test_files_keep_microseconds(spark, tmp_path):
    moment = datetime(2025, 6, 1, 12, 0, 0, 123456)
    df = spark.createDataFrame([(moment, moment)], "t timestamp, n timestamp_ntz")
    files.write_csv(df, str(tmp_path / "a.csv"))
    files.write_json(df, str(tmp_path / "a.json"))
    for name in ("a.csv", "a.json"):
        row = files.read_any(spark, str(tmp_path / name), schema=df.schema).collect()[0]
        assert tuple(row) == (moment, moment)


def test_unknown_extensions(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_any(spark, str(tmp_path / "data.xlsx"))
    with pytest.warns(UserWarning):
        assert files.read_any(spark, str(tmp_path / "data"), on_unknown="skip") is None


def test_prediction_files(spark, tmp_path):
    (tmp_path / "good.csv").write_text("timestamp,v\n2025-06-01T00:00:00Z,1\n")
    (tmp_path / "bad.csv").write_text("time,v\n2025-06-01,1\n")
    (tmp_path / "empty.csv").write_text("timestamp,v\n")
    df = files.read_for_prediction(spark, str(tmp_path / "good.csv"))
    assert dict(df.dtypes)["timestamp"] == "timestamp"
    for name in ("bad.csv", "empty.csv"):
        with pytest.raises(ValueError):
            files.read_for_prediction(spark, str(tmp_path / name))


def test_local_files_are_looked_up_in_every_folder(spark, tmp_path):
    for folder, name, text in (("x", "a.csv", "k,v\n1,2\n"), ("y", "a.csv", "k,v\n3,z\n"), ("y", "b.json", '{"k": 5}')):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    folders = [str(tmp_path / "x"), str(tmp_path / "y") + "/", str(tmp_path / "absent")]
    assert len(files.existing_files(spark, folders, ["a.csv", "b.json", "c.csv"])) == 3
    out = files.read_local(spark, folders, ["a.csv", "b.json", "c.csv"])
    assert sorted((r.k, r.v) for r in out.where("v IS NOT NULL").collect()) == [(1, "2"), (3, "z")]
    assert out.count() == 3
    assert files.read_local(spark, folders, ["c.csv"]) is None


def test_table_names():
    assert check_identifier("demo_1") == "demo_1"
    for bad in ("demo; drop", "a.b", ""):
        with pytest.raises(ValueError):
            check_identifier(bad)


def test_sql_types():
    schema = T.StructType.fromDDL("a int, b double, c timestamp, d boolean, e string, f decimal(5,2), g date")
    assert [relational.sql_type(f.dataType) for f in schema] == [
        "BIGINT", "FLOAT", "TIMESTAMP", "BOOLEAN", "TEXT", "FLOAT", "TIMESTAMP",
    ]
    assert relational.column_types(T.StructType.fromDDL("a int, b string")) == "`a` BIGINT, `b` STRING"


def test_scan_options():
    assert relational.scan_options(table="demo") == {"dbtable": "demo"}
    assert relational.scan_options(query="SELECT 1") == {"query": "SELECT 1"}
    split = relational.scan_options(query="SELECT * FROM t", partition_column="id", bounds=(0, 100), partitions=4)
    assert split["dbtable"] == "(SELECT * FROM t) AS q" and split["numPartitions"] == "4"
    for bad in ({}, {"table": "a", "query": "b"}, {"table": "a", "partition_column": "id"}):
        with pytest.raises(ValueError):
            relational.scan_options(**bad)


def test_empty_frames_are_not_written(spark):
    """Returns before any connection is made."""
    empty = spark.createDataFrame([], "a int")
    assert relational.write_jdbc(empty, "jdbc:none", "demo") is False
    with pytest.raises(ValueError):
        relational.write_jdbc(empty, "jdbc:none", "bad name")


def test_sql_parameters_are_bound(spark):
    spark.createDataFrame([(1, "a"), (700, "it's"), (900, "c")], "v int, s string").createOrReplaceTempView("bound")
    lines = ["SELECT * FROM {table}", "WHERE {filter_field} > {filter_value}", "LIMIT {limit}"]
    params = {"table": "bound", "filter_field": "v", "filter_value": 500.0, "limit": 100, "unused": 1}
    assert relational.run_sql(spark, lines, params).count() == 2
    found = relational.run_sql(spark, "SELECT * FROM bound WHERE s = {text}", {"text": "it's"})
    assert [r.v for r in found.collect()] == [700]


def test_json_files_of_both_layouts(spark, tmp_path):
    (tmp_path / "array.json").write_text('[\n {"a": 1},\n {"a": 2}\n]\n')
    (tmp_path / "lines.json").write_text('\n{"a": 3}\n{"a": 4}\n{"a": 5}\n')
    paths = [str(tmp_path / "array.json"), str(tmp_path / "lines.json")]
    for order in (paths, paths[::-1]):
        out = files.read_json(spark, order, "a long")
        assert out.columns == ["a"] and sorted(r.a for r in out.collect()) == [1, 2, 3, 4, 5]


def test_csv_keeps_awkward_text(spark, tmp_path):
    values = ["a\nb", 'say "x", y', "", None, "plain", " spaced ", "c,d\r\ne"]
    df = spark.createDataFrame(list(enumerate(values)), "i long, t string")
    files.write_csv(df, str(tmp_path / "odd.csv"))
    out = files.read_any(spark, str(tmp_path / "odd.csv"), schema=df.schema).orderBy("i").collect()
    assert [r.t for r in out] == values


def test_annotated_files_with_other_headers(spark, tmp_path):
    for name, field, kind, value in (("one", "aaa", "double", "1.5"), ("two", "bbb", "long", "7"), ("three", "aaa", "double", "2.5")):
        head = annotated.head_lines("_measurement", ["zone"], "_time", {field: kind})
        (tmp_path / f"{name}.csv").write_text("\n".join([*head, f",m,z,2025-06-01T00:00:00.000Z,{value}"]) + "\n")
    rows = annotated.read_annotated_csv(spark, str(tmp_path)).orderBy("aaa").collect()
    assert [(r.aaa, r.bbb) for r in rows] == [(None, 7), (1.5, None), (2.5, None)]
    (tmp_path / "bad.csv").write_text(",_measurement,_time\n,m,2025-06-01T00:00:00.000Z\n")
    with pytest.raises(ValueError, match="datatype"):
        annotated.read_annotated_csv(spark, str(tmp_path))


def test_annotated_text_with_line_breaks(spark, tmp_path):
    rows = [("m", datetime(2025, 6, 1, 0, i), t, float(i)) for i, t in enumerate(["a\nb", "#c", 'q "x", y', "", None])]
    df = spark.createDataFrame(rows, "_measurement string, _time timestamp, note string, v double")
    annotated.write_annotated_csv(df, str(tmp_path / "out"), [], ["note", "v"])
    out = annotated.read_annotated_csv(spark, str(tmp_path / "out")).orderBy("v").collect()
    assert [(r["_measurement"], r.note, r.v) for r in out] == [("m", t, float(i)) for i, t in enumerate(["a\nb", "#c", 'q "x", y', "", None])]


def test_quoted_placeholders_are_bound(spark):
    spark.createDataFrame([("x", 1), ("y", 2)], "tag string, n long").createOrReplaceTempView("tagged")
    assert relational.run_sql(spark, "SELECT * FROM tagged WHERE tag = '{tag}'", {"tag": "x"}).count() == 1
    with pytest.raises(ValueError):
        relational.run_sql(spark, "SELECT * FROM tagged WHERE tag = 'a {tag} b'", {"tag": "x"})


@pytest.mark.parametrize("folder", ["my data", "50% off", "a#b", "größe ñ", "x+y", "plain{1}[2]"])
def test_odd_folder_names(spark, tmp_path, folder):
    """Files are found again by the names Spark gives of them, whatever the characters."""
    base = str(tmp_path / folder)
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    os.makedirs(f"{base}/mixed")
    with open(f"{base}/mixed/array.json", "w") as f:
        f.write('[{"a": 1, "b": "x"},\n {"a": 2, "b": "y"}]')
    with open(f"{base}/mixed/lines.json", "w") as f:
        f.write('{"a": 3, "b": "z"}\n')
    mixed = files.read_json(spark, files.literal_path(f"{base}/mixed"), df.schema)
    assert sorted(map(tuple, mixed.collect())) == [(1, "x"), (2, "y"), (3, "z")]
    wide = df.select(F.lit("m").alias("_measurement"), F.col("b").alias("tag"), F.lit("2025-06-01").cast("timestamp").alias("_time"), "a")
    annotated.write_annotated_csv(wide, f"{base}/annotated", ["tag"], ["a"])
    back = annotated.read_annotated_csv(spark, files.literal_path(f"{base}/annotated"))
    assert sorted((r["tag"], r["a"]) for r in back.collect()) == [("x", 1), ("y", 2)]


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    df = spark.range(20_000).select("id", F.concat(F.lit('say "'), F.col("id").cast("string"), F.lit('", twice')).alias("t"))
    files.write_csv(df.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        split, whole = (files.read_csv(spark, path, df.schema, line_breaks=b) for b in (False, True))
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _series(spark, rows):
    return spark.createDataFrame(rows, "bucket string, _measurement string, _time timestamp, _field string, _value double, floor string")


def test_catalogue_follows_every_write(spark, tmp_path):
    path = str(tmp_path / "points of a site")
    t = lambda day, hour=0: datetime(2025, 6, day, hour)
    extent = lambda: sorted(tuple(r) for r in catalogue.series_extent(catalogue.series_catalogue(spark, path)).select("bucket", "_field", "floor", "first_time", "last_time", "n_rows").collect())
    series_table.write_points(_series(spark, [("b 1", "m", t(1), "x", 1.0, "0"), ("b 1", "m", t(2), "x", 1.0, "0"), ("007", "m", t(1), "y", 1.0, None)]), path)
    assert extent() == [("007", "y", None, t(1), t(1), 1), ("b 1", "x", "0", t(1), t(2), 2)]
    first = catalogue._versions(spark, path)
    assert extent() and catalogue._versions(spark, path) == first  # nothing changed, nothing written
    series_table.write_points(_series(spark, [("b 1", "m", t(9), "x", 1.0, "0"), ("b 1", "n", t(3), "z", 1.0, "1")]), path)
    assert extent() == [("007", "y", None, t(1), t(1), 1), ("b 1", "x", "0", t(1), t(9), 3), ("b 1", "z", "1", t(3), t(3), 1)]
    series_table.replace_buckets(_series(spark, [("b 1", "m", t(4, 12), "x", 1.0, "0")]), path)
    assert extent() == [("007", "y", None, t(1), t(1), 1), ("b 1", "x", "0", t(4, 12), t(4, 12), 1), ("b 1", "z", "1", t(3), t(3), 1)]
    assert len(catalogue._versions(spark, path)) == 2
    found = catalogue.series_catalogue(spark, path)
    fields = lambda *a, **k: sorted(r["_field"] for r in catalogue.field_keys_of(found, *a, **k).collect())
    assert fields("2025-06-04T12:00:00Z", 1) == ["z"] or fields("2025-06-04T12:00:00Z", 1) == []
    assert fields("2025-06-04T12:00:01Z", 1) == ["x"] and fields("2025-06-05", 100) == ["x", "y", "z"]
    assert fields("2025-06-05", 100, buckets=["007"]) == ["y"]
    assert sorted(r.bucket for r in select.bucket_names(found, exclude=["007"]).collect()) == ["b 1"]
    read = select.bucket_names(found).inputFiles()
    assert read and all("/_catalogue/" in name for name in read)
    assert series_table.scan_points(spark, path).count() == 3  # the catalogue is no part of the table
    series_table.write_points(_series(spark, [("new", "m", t(5), "x", 1.0, "0")]), path, mode="overwrite")
    assert [r[0] for r in extent()] == ["new"]


def test_extent_of_entries_is_grouped_once(spark, tmp_path):
    """A table with about as many entries as points: names of files are cut without a pattern, and series are grouped from entries in one shuffle."""
    path = str(tmp_path / "points of a site")
    for first in (1, 9):
        rows = [("b 1", "m", datetime(2025, 6, day), f"x{i}", 1.0, "0") for day in range(first, first + 8) for i in range(5)]
        series_table.write_points(_series(spark, rows), path)
        entries = catalogue.refresh_catalogue(spark, path)
    extent = catalogue.series_extent(entries)
    by_day = catalogue.series_extent(catalogue.series_catalogue(spark, path))
    assert extent.columns == by_day.columns and sorted(map(tuple, extent.collect())) == sorted(map(tuple, by_day.collect()))
    assert extent.count() == 5 and {(r["n_rows"], r["first_time"], r["last_time"]) for r in extent.collect()} == {(16, datetime(2025, 6, 1), datetime(2025, 6, 16))}
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert plan(extent).count("HashAggregate") == 2 < plan(by_day).count("HashAggregate")  # partial and final
    found = catalogue._entries(series_table.scan_points(spark, path))
    assert "regexp" not in plan(found) and {r["file"].count("/") for r in found.collect()} == {2}


def test_points_up_to_an_end(spark, tmp_path):
    path = str(tmp_path / "p")
    times = [datetime(1969, 12, 31), datetime(2025, 6, 1), datetime(2025, 6, 2)]
    series_table.write_points(_series(spark, [("b", "m", t, "x", 1.0, "0") for t in times]), path)
    assert series_table.scan_points(spark, path, stop="2025-06-02").count() == 2
    assert series_table.scan_points(spark, path, start="2025-06-01").count() == 2
    assert series_table.scan_points(spark, path).count() == 3
