"""Row-wise fusion of heterogeneous sources."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators.select import with_bucket

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def common_type(kinds: list[T.DataType]) -> T.DataType:
    """The type all of ``kinds`` are read as: equal, the wider number, an instant, else text."""
    kinds = [k for k in kinds if not isinstance(k, T.NullType)] or [T.StringType()]
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType() if any(isinstance(k, _FRACTIONAL) for k in kinds) else T.LongType()
    if all(isinstance(k, _TIMES) for k in kinds):
        return T.TimestampType() if any(isinstance(k, T.TimestampType) for k in kinds) else T.TimestampNTZType()
    return T.StringType()


def fuse(sources: Iterable[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column that a source lacks is null there."""
    frames = list(sources)
    if not frames:
        raise ValueError("no data source to fuse")
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    target = {name: common_type(found) for name, found in kinds.items()}

    def column(field: T.StructField) -> Column:
        found = F.col(f"`{field.name}`")
        wanted = target[field.name]
        return found if field.dataType == wanted else found.cast(wanted).alias(field.name)

    def aligned(frame: DataFrame) -> DataFrame:
        return frame.select(*[column(field) for field in frame.schema])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(aligned, frames))


def union_buckets(frames: dict[str, DataFrame]) -> DataFrame:
    """Separate per-bucket frames as one, each tagged with its bucket's name."""
    return fuse(with_bucket(frame, name) for name, frame in frames.items())
