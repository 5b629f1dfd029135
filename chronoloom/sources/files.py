"""Local and shared files: CSV, JSON, Parquet."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import extension
from chronoloom.operators.fuse import fuse

# The writers' own default drops what is finer than a millisecond.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None, line_breaks: bool = True
) -> DataFrame:
    """CSV with a header; quoted text may hold line breaks, commas and doubled quotes.

    Without a schema the types are inferred, at the cost of one more read. A file is read by one
    task, as a line break may stand inside a value. Files without line breaks inside values, by ``line_breaks=False``, are split
    among many tasks.
    """
    # Nothing between two commas is null and two quotes are an empty text; the null mark itself stands in no file.
    reader = spark.read.options(header=True, multiLine=line_breaks, escape='"', nullValue="\u0000")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(_paths(paths))


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines, or files that each hold one array of records, or both kinds among the files read.

    Each file is looked at by itself. A file holding one array is one record to split, so large
    data belongs in JSON lines.
    """
    arrays, lines = _by_layout(spark, _paths(paths))
    frames = []
    for found, whole in ((lines, False), (arrays, True)):
        if found:
            reader = spark.read.option("multiLine", whole)
            frames.append((reader.schema(schema) if schema else reader).json(found))
    return frames[0] if len(frames) == 1 else fuse(frames)


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*_paths(paths))


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def file_name(column: str = "_metadata.file_path") -> Column:
    """The name of each row's file as a reader takes it: Spark writes names as URIs, with a blank as ``%20``, and plus signs stand for themselves."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def _by_layout(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """Files that hold one array, and the others, of files and folders. An array's file starts with a bracket."""
    named = spark.read.option("recursiveFileLookup", True).text(paths).select(file_name().alias("file"), F.ltrim("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    # Names and first characters only, one row a file.
    first = named.where("line <> ''").groupBy("file").agg(F.min_by(F.substring("line", 1, 1), "at").alias("mark"))
    marks = {row["file"]: row["mark"] for row in first.collect()}
    arrays = [file for file, mark in marks.items() if mark == "["]
    if not arrays:
        return [], paths
    return [literal_path(f) for f in sorted(arrays)], [literal_path(f) for f in sorted(f for f, mark in marks.items() if mark != "[")]


def literal_path(path: str) -> str:
    """A path whose own characters are not read as patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_any(
    spark: SparkSession,
    path: str,
    on_unknown: str = "raise",
    schema: T.StructType | str | None = None,
) -> DataFrame | None:
    """Read a file by its extension. An unknown one raises, or warns and gives None."""
    kind = extension(path)
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind == "json":
        return read_json(spark, path, schema)
    if kind == "parquet":
        return read_parquet(spark, path)
    if on_unknown == "skip":
        warnings.warn(f"skipped {path!r}: no reader for {kind or 'files without extension'!r}", stacklevel=2)
        return None
    raise ValueError(f"unsupported file type for {path!r}")


def read_for_prediction(spark: SparkSession, path: str, timestamp: str = "timestamp") -> DataFrame:
    """Prediction input: unknown types and empty data raise; a CSV must have a timestamp column."""
    df = read_any(spark, path, on_unknown="raise")
    if extension(path) == "csv":
        if timestamp not in df.columns:
            raise ValueError(f"{path!r} has no column {timestamp!r}")
        df = df.withColumn(timestamp, F.col(timestamp).cast("timestamp"))
    if df.isEmpty():
        raise ValueError(f"no rows in {path!r}")
    return df


def existing_files(spark: SparkSession, folders: Sequence[str], files: Sequence[str]) -> list[str]:
    """Every folder crossed with every file name, keeping the paths that exist."""
    found = []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        for name in files:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
            if path.getFileSystem(conf).exists(path):
                found.append(path.toString())
    return found


def read_local(spark: SparkSession, folders: Sequence[str], files: Sequence[str]) -> DataFrame | None:
    """All listed files found in the folders, fused; files of unknown type are skipped."""
    frames = [read_any(spark, path, on_unknown="skip") for path in existing_files(spark, folders, files)]
    frames = [frame for frame in frames if frame is not None]
    return fuse(frames) if frames else None


def write_csv(df: DataFrame, path: str) -> None:
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "emptyValue": '""'}
    df.write.mode("overwrite").options(header=True, **kept, **MICROSECONDS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**MICROSECONDS).json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
