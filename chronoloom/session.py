"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. Partition counts are left to adaptive execution, which
# coalesces small shuffle partitions and splits skewed ones.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "chronoloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: window alignment and time parsing assume UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package also where a session was started from another folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [path for path in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh temporary folder, made its checkpoint folder.
    On a cluster such a folder would exist on one machine only, so there a missing setting is an
    error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="chronoloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
