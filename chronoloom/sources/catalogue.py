"""A catalogue of the series of a point table, so that discovery reads no points.

It lies in the table's own folder, hidden from reads, and holds for each file, series and day the first and last time and the number of rows.
Entries belong to files, so the catalogue follows every append, overwrite and outside change: entries of files that are gone
do not count, files without entries are read once. Each change writes a new version and the one before stays, for readers that have begun.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.schema import BUCKET, FIELD, MEASUREMENT, TIME, VALUE, VALUE_TEXT, instant_literal, parse_instant
from chronoloom.sources.series_table import scan_points, text_layout

FOLDER = "_catalogue"
KEPT_VERSIONS = 2

FILE, DAY, FIRST, LAST, ROWS = "file", "day", "first_time", "last_time", "n_rows"


def _hadoop(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written to their end."""
    folder, fs = _hadoop(spark, f"{path}/{FOLDER}")
    if not fs.exists(folder):
        return []
    found = [status.getPath() for status in fs.listStatus(folder)]
    done = [p for p in found if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("version=")) for p in done)


def _file_key(path):
    """The part of a file's path that is the table's own: its bucket, measurement and name, as written in paths."""
    return F.substring_index(path, "/", -3)


def _entries(points: DataFrame) -> DataFrame:
    """A row for each file, series and day; combined before the shuffle."""
    keys = [f.name for f in points.schema if isinstance(f.dataType, T.StringType) and f.name not in (VALUE, VALUE_TEXT)]
    file = _file_key(F.col("_metadata.file_path")).alias(FILE)
    return points.groupBy(file, *keys, F.to_date(TIME).alias(DAY)).agg(
        F.min(TIME).alias(FIRST), F.max(TIME).alias(LAST), F.count(F.lit(1)).alias(ROWS)
    )


def refresh_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The entries of all present files; files that have none yet are read, and a new version is written if anything changed.

    File names are listed on the driver, as every read of the table does.
    """
    names = scan_points(spark, path).inputFiles()
    present = spark.createDataFrame([(name,) for name in names], "path string").select("path", _file_key(F.col("path")).alias(FILE)).distinct()
    versions = _versions(spark, path)
    known = None
    missing = names
    stale = 0
    if versions:
        known = spark.read.parquet(f"{path}/{FOLDER}/version={versions[-1]}")
        listed = known.select(FILE).distinct()
        missing = [row.path for row in present.join(listed, FILE, "left_anti").select("path").collect()]
        stale = listed.join(present, FILE, "left_anti").count()
        known = known.join(present.select(FILE), FILE, "left_semi")
    if not missing and not stale:
        return known
    parts = [] if known is None else [known]
    if missing:
        schema = text_layout(spark.read.parquet(path).schema)
        parts.append(_entries(spark.read.schema(schema).option("basePath", path).parquet(*[_decoded(spark, name) for name in missing])))
    entries = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    target = f"{path}/{FOLDER}/version={versions[-1] + 1 if versions else 0}"
    entries.write.mode("overwrite").parquet(target)
    for version in versions[: 1 - KEPT_VERSIONS]:
        old, fs = _hadoop(spark, f"{path}/{FOLDER}/version={version}")
        fs.delete(old, True)
    return spark.read.parquet(target)


def _decoded(spark: SparkSession, name: str) -> str:
    """The path behind a file name as Spark lists it, where a blank is ``%20``."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name)).toString()


def series_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Per series and day the first and last time and the rows, over all files there are now."""
    entries = refresh_catalogue(spark, path)
    keys = [c for c in entries.columns if c not in (FILE, FIRST, LAST, ROWS)]
    return entries.groupBy(*keys).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST), F.sum(ROWS).alias(ROWS))


def series_extent(catalogue: DataFrame) -> DataFrame:
    """Per series its first and last time and its rows, of a catalogue or, without its grouping by day, of the entries themselves."""
    keys = [c for c in catalogue.columns if c not in (FILE, DAY, FIRST, LAST, ROWS)]
    return catalogue.groupBy(*keys).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST), F.sum(ROWS).alias(ROWS))


def field_keys_of(catalogue: DataFrame, as_of: str | datetime, days: int = 100, buckets: Iterable[str] = ()) -> DataFrame:
    """Distinct field names with a point in the ``days`` before ``as_of``, of the named buckets or of all.

    Exact for a day and more: an entry counts if its first or its last point lies inside.
    """
    end = parse_instant(as_of)
    kind = catalogue.schema[FIRST].dataType
    low, high = (instant_literal(t, kind) for t in (end - timedelta(days=days), end))
    inside = [(F.col(c) >= low) & (F.col(c) < high) for c in (FIRST, LAST)]
    found = catalogue.where(inside[0] | inside[1])
    wanted = list(buckets)
    return (found.where(F.col(BUCKET).isin(wanted)) if wanted else found).select(FIELD).distinct()


def measurements_of(catalogue: DataFrame) -> DataFrame:
    """Distinct pairs of bucket and measurement."""
    return catalogue.select(BUCKET, MEASUREMENT).distinct()
