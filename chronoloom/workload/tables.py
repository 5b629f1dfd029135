"""Benchmark tables, and the event table seen as long-form sensor points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.schema import BUCKET, FIELD, MEASUREMENT, TIME, VALUE

FIELDS = ["click", "error", "purchase", "signup", "view"]
TAGS = ["system_id", "floor", "equipment_number"]
SERIES = [BUCKET, MEASUREMENT, FIELD, *TAGS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_points(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    traffic = F.col("event_type").isin("click", "view")
    return events.select(
        F.col("ts").alias(TIME),
        F.concat(F.lit("b"), (user % 4).cast("string")).alias(BUCKET),
        F.when(traffic, "traffic").otherwise("action").alias(MEASUREMENT),
        F.col("event_type").alias(FIELD),
        F.col("value").alias(VALUE),
        (user % 10).cast("string").alias("system_id"),
        (user % 3).cast("string").alias("floor"),
        user.cast("string").alias("equipment_number"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_points(table(spark, sf_dir, "events"))
