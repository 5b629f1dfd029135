"""Tables written to the shared folder and read again, which cuts lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chronoloom.session import scratch_path


def fresh(frame: DataFrame, *wanted: str) -> list[str]:
    """Column names near the wanted ones that ``frame`` does not have, compared as Spark compares names."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """``frame`` as a table in the shared folder, by the writer's ``options``; a lost executor costs no more than the job that reads it."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.parquet(path)
