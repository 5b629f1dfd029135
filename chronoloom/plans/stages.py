"""Stages that users chain and extend, on the pyspark.ml protocol."""

from __future__ import annotations

import inspect
import warnings
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from operator import and_

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators.fill import with_lags
from chronoloom.operators.fuse import fuse
from chronoloom.operators.sync import synchronise
from chronoloom.schema import BUCKET, SYNC_KEYS, TIME, VALUE
from chronoloom.session import scratch_path


# Kinds of attributes that a stage shows of itself.
PLAIN = (bool, int, float, str, list, tuple, dict)


class Described(Params):
    """What every stage of a chain can say about itself."""

    def info(self) -> str:
        return f"{type(self).__name__} {self.uid}"

    def attributes(self) -> dict:
        """Parameters by name, and the plain public attributes of the class and the stage."""
        plain = {n: v for c in reversed(type(self).__mro__) for n, v in vars(c).items() if isinstance(v, PLAIN)}
        plain |= {n: v for n, v in vars(self).items() if isinstance(v, PLAIN)}
        set_ = {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}
        return {n: v for n, v in plain.items() if not n.startswith("_") and n != "uid"} | set_

    def source_file(self) -> str | None:
        """The file that defines the stage."""
        return inspect.getsourcefile(type(self))

    def results(self, df: DataFrame) -> dict[str, DataFrame]:
        """Named result frames of this stage, given its output."""
        return {}

    def release(self) -> None:
        """Let go of what a fitted stage holds in memory; most hold nothing."""

    def update(self, **values) -> None:
        """Set parameters by name; names the stage lacks only warn."""
        for name, value in values.items():
            if self.hasParam(name):
                self.set(self.getParam(name), value)
            else:
                warnings.warn(f"{type(self).__name__} has no parameter {name!r}", stacklevel=2)


class Fuse(Described, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Combine the frames of a plan's sources. Subclasses override :meth:`fuse`."""

    parameters = Param(Params._dummy(), "parameters", "what the plan gives this step, by source")

    def __init__(self, **parameters):
        super().__init__()
        self._set(parameters=dict(parameters))

    def fuse(self, frames: Mapping[str, DataFrame]) -> DataFrame:
        return fuse(frames.values())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset


class Synchronise(Described, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Points to complete rows on a regular grid."""

    fields = Param(Params._dummy(), "fields", "field names to pivot", TypeConverters.toListString)
    keys = Param(Params._dummy(), "keys", "key columns", TypeConverters.toListString)
    step = Param(Params._dummy(), "step", "grid step", TypeConverters.toString)
    fillLimit = Param(Params._dummy(), "fillLimit", "rows filled at most", TypeConverters.toInt)
    fillScope = Param(Params._dummy(), "fillScope", "system or series", TypeConverters.toString)
    narrow = Param(Params._dummy(), "narrow", "wrap, try or none", TypeConverters.toString)
    split = Param(Params._dummy(), "split", "width of the time slots that fills are cut into", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, fields=None, keys=None, step=None, fillLimit=None, fillScope=None, narrow=None, split=None):
        super().__init__()
        self._setDefault(
            keys=list(SYNC_KEYS), step="5m", fillLimit=2, fillScope="system", narrow="none", split="1h"
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return synchronise(
            dataset,
            get(self.fields),
            get(self.keys),
            get(self.step),
            get(self.fillLimit),
            get(self.fillScope),
            None if get(self.narrow) == "none" else get(self.narrow),
            split=get(self.split),
        )


class LagFeatures(Described, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Add earlier values of a column as features; rows without them are dropped.

    Without ``split`` a series is ordered by one task, which suits window aggregates, whose series hold one row per window of
    the range. Raw points take slots, by width or by counts (``"100000 rows"``).
    """

    inputCol = Param(Params._dummy(), "inputCol", "column to lag", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "series keys", TypeConverters.toListString)
    lags = Param(Params._dummy(), "lags", "how many rows back", TypeConverters.toListInt)
    split = Param(Params._dummy(), "split", "slots that series are cut into", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, keys=None, lags=None, split=None):
        super().__init__()
        self._setDefault(inputCol=VALUE, lags=[1])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def names(self) -> list[str]:
        return [f"lag_{n}" for n in self.getOrDefault(self.lags)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source = self.getOrDefault(self.inputCol)
        lags = dict(zip(self.names(), self.getOrDefault(self.lags)))
        split = self.getOrDefault(self.split) if self.isDefined(self.split) else None
        return with_lags(dataset, self.getOrDefault(self.keys), source, lags, split=split).dropna(subset=[source, *lags])


class _CentreParams(Described):
    inputCol = Param(Params._dummy(), "inputCol", "value column", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "columns that tell groups apart", TypeConverters.toListString)


class Centre(_CentreParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learn each group's mean and deviation; by default a group is a bucket.

    What is learned is written to the shared folder while fitting, so a model does not depend on the training data afterwards.
    """

    @keyword_only
    def __init__(self, *, inputCol=None, keys=None):
        super().__init__()
        self._setDefault(inputCol=VALUE, keys=[BUCKET])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CentreModel:
        stats = sufficient_statistics(dataset, self.getOrDefault(self.keys), self.getOrDefault(self.inputCol))
        path = scratch_path(dataset.sparkSession, "centre")
        stats.write.parquet(path)
        return self._copyValues(CentreModel(dataset.sparkSession.read.parquet(path)))


class CentreModel(_CentreParams, Model, MLWritable, MLReadable):
    """Predict the group's mean, with the residual, its score in deviations and the probability of one as large.

    The probability is that of a residual at least this large if values are normally spread.
    """

    def __init__(self, stats: DataFrame | None = None):
        super().__init__()
        self._setDefault(inputCol=VALUE, keys=[BUCKET])
        self.stats = stats

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value, keys = self.getOrDefault(self.inputCol), self.getOrDefault(self.keys)
        ids = [f"__key_{i}" for i in range(len(keys))]
        # One row per group; the size found at run time decides whether it is broadcast.
        learned = moments(self.stats).select(*[F.col(k).alias(i) for k, i in zip(keys, ids)], "mean", "std")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(i)) for k, i in zip(keys, ids)])
        residual = F.col(value) - F.col("mean")
        return dataset.join(learned, same, "left").select(
            *dataset.columns,
            F.col("mean").alias("prediction"),
            residual.alias("residual"),
            F.when(F.col("std") > 0, residual / F.col("std")).alias("score"),
        )

    def predict_proba(self, dataset: DataFrame) -> DataFrame:
        """The predictions with ``probability``, that of a residual as large or larger."""
        return self.transform(dataset).withColumn("probability", tail_probability(F.abs("score")))

    def release(self) -> None:
        """Drop the learned table if it is held in memory; the written one stays."""
        if self.stats is not None:
            self.stats.unpersist()

    def partial_fit(self, df: DataFrame) -> CentreModel:
        """A model that has also seen ``df``; statistics merge, so earlier rows are not needed."""
        keys = self.getOrDefault(self.keys)
        seen = self.stats.unionByName(sufficient_statistics(df, keys, self.getOrDefault(self.inputCol)))
        return self._copyValues(CentreModel(merged_statistics(seen, keys)))

    def results(self, df: DataFrame) -> dict[str, DataFrame]:
        return {"learned": moments(self.stats)}

    def write(self) -> MLWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls)


class TableWriter(MLWriter):
    """Saves a model whose learned values are a table, ``stats``."""

    def __init__(self, instance: Model):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.stats.write.parquet(f"{path}/stats")


class TableReader(MLReader):
    """Loads a model that ``TableWriter`` saved."""

    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Model:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/stats"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def sufficient_statistics(df: DataFrame, keys: list[str], value: str = VALUE) -> DataFrame:
    """Count, mean and sum of squared distances from the mean per key: what a mean and deviation need, and mergeable.

    Sums of squares of the values themselves would lose the deviation of large readings to rounding.
    """
    v = F.col(value).cast("double")
    n = F.count(v)
    return df.groupBy(*keys).agg(n.alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * n).alias("m2"))


def merged_statistics(stats: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key from several; a key has as many rows as there are batches to merge."""
    parts = F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2"))))

    def add(one, other):
        n = one["n"] + other["n"]
        apart = other["mean"] - one["mean"]
        mean = one["mean"] + apart * other["n"] / n
        m2 = one["m2"] + other["m2"] + apart * apart * one["n"] * other["n"] / n
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))

    gathered = stats.groupBy(*keys).agg(parts.alias("__parts"))
    first = F.try_element_at("__parts", F.lit(1))
    rest = F.slice("__parts", F.lit(2), F.greatest(F.size("__parts") - 1, F.lit(0)))
    total = gathered.withColumn("__sum", F.aggregate(rest, first, add))
    return total.select(*keys, F.coalesce("__sum.n", F.lit(0).cast("long")).alias("n"), "__sum.mean", "__sum.m2")


def moments(stats: DataFrame) -> DataFrame:
    """Statistics with the sample deviation worked out."""
    return stats.withColumn("std", F.sqrt(F.col("m2") / F.when(F.col("n") > 1, F.col("n") - 1)))


def tail_probability(score):
    """Probability that a standard normal value lies at least ``score`` (0 or more) from 0, to about seven digits."""
    # Abramowitz and Stegun 7.1.26 for the complementary error function at score / sqrt(2); its fixed values.
    x = score / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return series * F.exp(-x * x)


def predict_rows_per_bucket(
    df: DataFrame,
    predict: Callable[[str, object], object],
    schema: T.StructType | str,
    bucket: str = BUCKET,
) -> DataFrame:
    """Apply a row by row pandas model bucket by bucket: ``predict(bucket, frame) -> frame``.

    The model sees rows of one bucket at a time, some of them per call, and so must predict each
    row from that row alone. Nothing is shuffled or sorted, however large a bucket is. A model that
    looks at a whole group belongs in ``predict_groups``.
    """

    def by_bucket(batches: Iterator) -> Iterator:
        for batch in batches:
            for name, rows in batch.groupby(bucket, sort=False, dropna=False):
                yield predict(name, rows.reset_index(drop=True))

    return df.mapInPandas(by_bucket, schema)


def predict_groups(df: DataFrame, predict: Callable[[tuple, object], object], schema: T.StructType | str, keys: list[str]) -> DataFrame:
    """Apply a pandas model to whole groups: ``predict(key values, frame) -> frame``, all rows of a group in one call.

    A group is one task's frame, so ``keys`` must bound it: for raw points a bucket, its series and
    a time slot (``slot_of``), for window aggregates a bucket and its series. Rows come in no order.
    """
    return df.groupBy(*keys).applyInPandas(predict, schema)


def slot_of(time: str = TIME, width: str = "1 day"):
    """Start of the time slot that a row falls in, as a key that bounds groups of points."""
    return F.window(time, width)["start"].alias("slot")
