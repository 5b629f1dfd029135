"""The long-form point table on Parquet, partitioned by bucket and measurement."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators.reshape import wide_to_points
from chronoloom.operators.select import in_buckets, time_range, with_bucket
from chronoloom.schema import BUCKET, FIELD, MEASUREMENT, TIME, VALUE, type_of


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """Write points under ``bucket=/_measurement=`` folders.

    The rebalance hint sizes the files: adaptive execution merges small buckets and splits one
    that outgrows the target partition size, so no task writes a whole large bucket. Rows lie in
    time order within a file, so a range scan skips row groups.
    """
    layout = [BUCKET, MEASUREMENT]
    points.hint("rebalance", *layout).sortWithinPartitions(*layout, TIME).write.mode(mode).partitionBy(*layout).parquet(path)


def replace_buckets(points: DataFrame, path: str) -> None:
    """Replace the buckets' measurements that ``points`` holds by them; the other ones stay."""
    layout = [BUCKET, MEASUREMENT]
    rows = points.hint("rebalance", *layout).sortWithinPartitions(*layout, TIME)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*layout).parquet(path)


def upload_wide(
    df: DataFrame,
    path: str,
    bucket: str,
    tags: Sequence[str],
    fields: Sequence[str],
    measurement: str = MEASUREMENT,
    timestamp: str = TIME,
    mode: str = "append",
) -> None:
    """Wide rows to points of one bucket, all measurements in one pass.

    Numeric fields go to ``_value``; text and boolean fields go to ``_value_text``.
    """
    keyed = df.select(
        F.col(measurement).alias(MEASUREMENT), *tags, F.col(timestamp).cast("timestamp").alias(TIME), *fields
    )
    ids = [MEASUREMENT, *tags, TIME]
    numeric = [f for f in fields if type_of(df, f).typeName() not in ("string", "boolean")]
    other = [f for f in fields if f not in numeric]
    text = f"{VALUE}_text"
    parts = []
    if numeric:
        parts.append(wide_to_points(keyed, ids, numeric).withColumn(text, F.lit(None).cast("string")))
    if other:
        texts = keyed.select(*ids, *[F.col(f).cast("string").alias(f) for f in other])
        parts.append(
            wide_to_points(texts, ids, other, FIELD, text).withColumn(VALUE, F.lit(None).cast("double"))
        )
    points = parts[0]
    for part in parts[1:]:
        points = points.unionByName(part)
    write_points(with_bucket(points, bucket), path, mode)


def scan_points(
    spark: SparkSession,
    path: str,
    buckets: str | Sequence[str] = "all",
    start: str | int | datetime | None = None,
    stop: str | int | datetime | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Points of the chosen buckets in ``[start, stop)``, either end open if not given; bucket choice prunes folders."""
    table = spark.read.schema(text_layout(spark.read.parquet(path).schema)).parquet(path)
    return time_range(in_buckets(table, buckets, exclude), start, stop)


def text_layout(found: T.StructType) -> T.StructType:
    """The schema with bucket and measurement as text, so that a folder such as bucket=007 is not read as a number."""
    layout = {BUCKET, MEASUREMENT}
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in layout else f for f in found])
