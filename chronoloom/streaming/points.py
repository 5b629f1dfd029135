"""Streaming sources, windows and the synchronisation grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timefn import snap
from chronoloom.operators.window_agg import AGGREGATES
from chronoloom.schema import FIELD, SYNC_KEYS, TIME, VALUE, duration_seconds


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _event_time(points: DataFrame, delay: str) -> DataFrame:
    timed = points.withColumn(TIME, F.col(TIME).cast("timestamp"))
    return timed.withWatermark(TIME, f"{duration_seconds(delay)} seconds")


def stream_windows(points: DataFrame, every: str, fn: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Window aggregation of a stream; a window is emitted once no later point can reach it."""
    width = f"{duration_seconds(every)} seconds"
    windows = _event_time(points, delay).groupBy(F.window(TIME, width).alias("w"), *keys)
    value = AGGREGATES[fn](F.col(VALUE), F.col(TIME))
    return windows.agg(value.alias(VALUE)).select(*keys, F.col("w.end").alias(TIME), VALUE)


def stream_grid(
    points: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = SYNC_KEYS,
    step: str = "5m",
    delay: str = "10m",
) -> DataFrame:
    """The synchronisation grid of a stream, equal to the batch grid on closed grid steps.

    The same two aggregations run one after the other: per instant, then per grid step. Steps of an odd number of
    minutes are windows, of other widths see :func:`_instants_of_any_step`.
    """
    minutes, rest = divmod(duration_seconds(step), 60)
    value = F.col(VALUE).cast("double")
    narrow_points = points.select(TIME, *keys, FIELD, value.alias(VALUE)).dropna()
    wanted = narrow_points.where(~F.isnan(VALUE) & F.col(FIELD).isin(list(fields)))
    means = [F.avg(F.when(F.col(FIELD) == f, F.col(VALUE))).alias(f) for f in fields]
    again = [F.avg(f).alias(f) for f in fields]
    if rest or minutes % 2 == 0:
        instants = _instants_of_any_step(wanted, step, delay).groupBy("grid", TIME, *keys).agg(*means)
        steps = instants.groupBy("grid", *keys).agg(*again)
        return steps.select(F.unix_seconds("grid").alias(TIME), *keys, *fields)
    # Ceiling to the minute and rounding to a step of an odd number of minutes put into grid time ``g`` the instants after
    # ``g - (step + 1 min) / 2`` up to and including ``g + (step - 1 min) / 2``. A window starting one microsecond
    # after the lower bound holds exactly these.
    before = (minutes + 1) // 2
    instants = _event_time(wanted, delay).groupBy(TIME, *keys).agg(*means)
    offset = f"{minutes - before} minutes 1 microsecond"
    width = f"{minutes} minutes"
    steps = instants.groupBy(F.window(TIME, width, width, offset).alias("w"), *keys).agg(*again)
    grid_time = F.expr("(unix_micros(w.start) - 1) div 1000000") + F.lit(before * 60)
    return steps.select(grid_time.alias(TIME), *keys, *fields)


def _instants_of_any_step(points: DataFrame, step: str, delay: str) -> DataFrame:
    """Points with ``grid``, the instant of their grid step, which carries the watermark.

    Where an even step or one of seconds leaves ties, a tie belongs to the even multiple, so steps are not
    windows of equal width. The watermark therefore follows the grid time itself: a step is closed once a point
    belongs to a step more than ``delay`` after it.
    """
    at = F.timestamp_seconds(snap(F.col(TIME), step))
    return points.withColumn("grid", at).withWatermark("grid", f"{duration_seconds(delay)} seconds")


def run_available(stream: DataFrame, path: str) -> None:
    """Process everything that has arrived, append the output to a table, and stop.

    The checkpoint beside the table lets a later call, or a restart, go on where this one ended.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def streamed_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/table")
