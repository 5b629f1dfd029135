"""Predict and learn on the same stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def latest_model(spark: SparkSession, model, path: str, before: int | None = None):
    """The newest saved version of a model, or the one saved before a batch; else the given one."""
    known = [v for v in _versions(spark, f"{path}/models") if before is None or v < before]
    return type(model).load(f"{path}/models/version={known[-1]}") if known else model


def _drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the newest ``keep`` versions of a model."""
    for version in _versions(spark, path)[:-keep]:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def predict_and_partial_fit(stream: DataFrame, model, path: str, keep: int | None = None) -> None:
    """Predict every arriving batch with the model so far, then let the model learn from it.

    Each batch reads the version saved before it and writes its own predictions and version under
    its batch number, so a batch that is run again after a failure replaces its own output. A
    model without ``partial_fit`` only predicts. ``keep`` (2 or more) says how many versions stay,
    all by default; running a batch again needs the one before it.
    """
    if keep is not None and keep < 2:
        raise ValueError("the version before the newest is needed to run a batch again")

    def on_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        current = latest_model(spark, model, path, before=number)
        batch.persist()  # read twice
        try:
            current.transform(batch).write.mode("overwrite").parquet(f"{path}/predictions/batch={number}")
            if hasattr(current, "partial_fit"):
                learned = current.partial_fit(batch)
                learned.write().session(spark).overwrite().save(f"{path}/models/version={number}")
        finally:
            batch.unpersist()
        if keep is not None:
            _drop_versions(spark, f"{path}/models", keep)

    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/predictions")
