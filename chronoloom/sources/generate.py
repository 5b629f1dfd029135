"""Synthetic sensor rows for demonstrations and tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.text import draw_boolean, draw_choice, draw_integer, draw_text, draw_uniform
from chronoloom.schema import MEASUREMENT, TIME, duration_seconds, epoch_of, parse_instant

# Measurements, fields and tags of the demonstration data.
DEMO_SCHEMA = {
    "measurement_1": {"field_11": "double", "field_12": "long", "field_13": "string"},
    "measurement_2": {"field_21": "double", "field_22": "boolean"},
}
DEMO_TAGS = {"tag_1": ["tag_11", "tag_12", "tag_13"], "tag_2": ["tag_21", "tag_22"]}


def clock(spark: SparkSession, start: str, end: str, interval_minutes: int = 1, time: str = TIME) -> DataFrame:
    """One row per interval over ``[start, end)``."""
    step = duration_seconds(f"{interval_minutes}m")
    first, last = (int(epoch_of(parse_instant(x))) for x in (start, end))
    return spark.range(first, last, step).select(F.timestamp_seconds("id").alias(time))


def _draw(identity: Column, name: str, kind: str) -> Column:
    if kind == "double":
        return F.round(draw_uniform(identity, name, 0.0, 1000.0), 3)
    if kind == "long":
        return draw_integer(identity, name, 0, 10000)
    if kind == "string":
        return draw_text(identity, name)
    if kind == "boolean":
        return draw_boolean(identity, name)
    raise ValueError(f"unknown field kind {kind!r}")


def sensor_rows(
    times: DataFrame,
    identity: Column | None = None,
    schema: Mapping[str, Mapping[str, str]] = DEMO_SCHEMA,
    tags: Mapping[str, Sequence[str]] = DEMO_TAGS,
    seed: int = 0,
    time: str = TIME,
    measurement: str = MEASUREMENT,
) -> DataFrame:
    """One wide row per row of ``times``: a drawn measurement, drawn tags, and that measurement's
    fields, all others null. Values depend only on ``identity`` and ``seed``.
    """
    who = F.concat_ws("/", F.lit(str(seed)), F.col(time).cast("string") if identity is None else identity)
    rows = times.select(
        draw_choice(who, measurement, list(schema)).alias(measurement),
        *[draw_choice(who, tag, list(tags[tag])).alias(tag) for tag in sorted(tags)],
        F.col(time),
        who.alias("__who"),
    )
    owners: dict[str, list[tuple[str, str]]] = {}
    for name, fields in schema.items():
        for field, kind in fields.items():
            owners.setdefault(field, []).append((name, kind))
    columns = []
    for field in sorted(owners):
        holders = [name for name, _ in owners[field]]
        value = _draw(F.col("__who"), field, owners[field][0][1])
        columns.append(F.when(F.col(measurement).isin(holders), value).alias(field))
    return rows.select(measurement, *sorted(tags), time, *columns)
