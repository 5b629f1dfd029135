"""Annotated CSV: three annotation rows, a header with an empty first cell, then rows.

Columns are the measurement, the tags in name order, the time, the fields in name order. The
writer puts the four head lines at the top of every part file, so that each one is a complete
annotated file by itself and a folder of them reads back as one table.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timefn import format_rfc3339
from chronoloom.operators.fuse import fuse
from chronoloom.schema import MEASUREMENT, TIME, type_of
from chronoloom.sources.files import file_name, literal_path

# Annotation labels and the words for column kinds in the first annotation row.
ANNOTATIONS = ("#datatype", "#group", "#default")
MEASUREMENT_KIND = "measurement"
TAG_KIND = "tag"
TIME_KIND = "dateTime:RFC3339"
FIELD_KINDS = {"double": T.DoubleType(), "long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType()}

_ROW_BITS = (1 << 33) - 1


def _kind_of(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.IntegralType):
        return "long"
    return "double" if isinstance(kind, T.NumericType) else "string"


def _line(cells: Sequence[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(cells)
    return out.getvalue()


def head_lines(measurement: str, tags: Sequence[str], time: str, fields: dict[str, str]) -> list[str]:
    """The three annotation rows and the header; ``fields`` maps names to kinds."""
    tags, names = sorted(tags), sorted(fields)
    datatype, group, default = ANNOTATIONS
    return [
        _line([datatype, MEASUREMENT_KIND, *[TAG_KIND] * len(tags), TIME_KIND, *[fields[n] for n in names]]),
        _line([group, "false", *["true"] * len(tags), "false", *["false"] * len(names)]),
        _line([default, "", *[""] * len(tags), "", *[""] * len(names)]),
        _line(["", measurement, *tags, time, *names]),
    ]


def write_annotated_csv(
    df: DataFrame,
    path: str,
    tags: Sequence[str],
    fields: Sequence[str],
    measurement: str = MEASUREMENT,
    time: str = TIME,
) -> None:
    """Write a wide frame as annotated CSV files, in parallel and without leaving the JVM."""
    head = head_lines(measurement, tags, time, {f: _kind_of(type_of(df, f)) for f in fields})
    columns = [measurement, *sorted(tags), time, *sorted(fields)]
    cells = []
    for c in columns:
        kind = type_of(df, c)
        if c == time:
            cell = format_rfc3339(F.col(c))
        elif isinstance(kind, T.BooleanType):
            cell = F.initcap(F.col(c).cast("string"))
        else:
            cell = F.col(c).cast("string")
        cells.append(cell.alias(c))
    row = F.concat(F.lit(","), F.to_csv(F.struct(*cells), {"escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}))
    # The low bits of this id count rows within a partition, and a partition becomes a file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)) == 0
    lines = df.select(row.alias("row"), first.alias("first")).select(
        F.explode(
            F.when(F.col("first"), F.array(*[F.lit(h) for h in head], F.col("row"))).otherwise(F.array("row"))
        ).alias("value")
    )
    lines.write.mode("overwrite").text(path)


def read_annotations(spark: SparkSession, path: str) -> list[tuple[dict[str, str], list[str]]]:
    """Column kinds by name with the files that have them, from each file's own first annotation row and header."""
    mark = ANNOTATIONS[0] + ","
    value = F.col("value")
    lines = spark.read.text(path).select(file_name().alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    heads = lines.groupBy("file").agg(
        F.count_if(value.startswith(mark)).alias("n"),
        F.min_by("value", F.when(value.startswith(mark), F.col("at"))).alias("kinds"),
        F.min_by("value", F.when(~value.startswith("#") & (F.trim("value") != ""), F.col("at"))).alias("header"),
    )
    # One row per layout; the names of files are all that is brought together.
    found = heads.groupBy("n", "kinds", "header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out = []
    for row in sorted(found, key=lambda r: r["files"]):
        if row["n"] != 1 or row["header"] is None:
            raise ValueError(f"{row['n']} {ANNOTATIONS[0]} rows and header {row['header']!r} in {row['files'][0]!r}")
        names, kinds = (next(csv.reader([line])) for line in (row["header"], row["kinds"]))
        out.append((dict(zip(names[1:], kinds[1:])), row["files"]))
    if not out:
        raise ValueError(f"no {ANNOTATIONS[0]} row in {path!r}")
    return out


def read_annotated_csv(spark: SparkSession, path: str, measurement: str = MEASUREMENT) -> DataFrame:
    """Read annotated CSV, types taken from the annotation rows, the empty first column dropped.

    Files of a folder may have other columns; each layout is read by its own and the frames are
    fused. Quoted text may hold line breaks, so a file is read by one task.
    """
    spark_types = {**FIELD_KINDS, TIME_KIND: T.TimestampType()}
    frames = []
    for kinds, found in read_annotations(spark, path):
        fields = [T.StructField("__empty", T.StringType())]
        fields += [T.StructField(name, spark_types.get(kind, T.StringType())) for name, kind in kinds.items()]
        reader = spark.read.options(comment="#", header=True, enforceSchema=True, multiLine=True, escape='"', nullValue="\u0000")
        frames.append(reader.schema(T.StructType(fields)).csv([literal_path(f) for f in found]).drop("__empty"))
    return frames[0] if len(frames) == 1 else fuse(frames)
