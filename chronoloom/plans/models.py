"""Many small models fitted in one job: a model per group, kept in a table of keys and parameters.

A pandas model is a class with ``fit(frame) -> dict or None`` and ``predict(parameters, frame) -> frame``, both static. Fitting sees
all rows of a group at once; parameters are plain values, saved as JSON. Prediction adds columns to rows and must take them row by row.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable
from functools import reduce
from operator import and_

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.regression import coefficients, fitted_value, gram_sums, merged_sums
from chronoloom.plans.stages import Described, TableReader, TableWriter, slot_of
from chronoloom.schema import BUCKET, VALUE
from chronoloom.session import find_package, scratch_path


class MedianBand:
    """A value's distance from the median of its group, in median distances: ``score``, and ``alarm`` beyond ``LIMIT`` of them."""

    OUTPUT = "prediction double, score double, alarm boolean"
    LIMIT = 3.0

    @staticmethod
    def fit(frame: pd.DataFrame) -> dict | None:
        values = frame[VALUE].dropna()
        if not len(values):
            return None
        middle = float(values.median())
        return {"median": middle, "spread": float((values - middle).abs().median())}

    @staticmethod
    def predict(parameters: dict, frame: pd.DataFrame) -> pd.DataFrame:
        score = (frame[VALUE] - parameters["median"]) / parameters["spread"] if parameters["spread"] > 0 else pd.Series(float("nan"), frame.index)
        alarm = (score.abs() > MedianBand.LIMIT).where(score.notna(), None)
        return frame.assign(prediction=parameters["median"], score=score, alarm=alarm)


# Models that plans may name without their module.
MODELS: dict[str, type] = {"MedianBand": MedianBand}


def model_class(name: str) -> type:
    """A registered model, or ``module.Class``."""
    if name in MODELS:
        return MODELS[name]
    module, _, attribute = name.rpartition(".")
    if not module:
        raise ValueError(f"unknown model {name!r}; registered: {sorted(MODELS)}")
    return getattr(importlib.import_module(module), attribute)


def fit_groups(df: DataFrame, fit: Callable[[pd.DataFrame], dict | None], keys: list[str], columns: list[str]) -> DataFrame:
    """A row for each group: its keys, ``parameters`` as JSON (null if the fit gave None) and ``n``, the rows it was fitted on.

    All groups are fitted by one job, as many at a time as there are tasks. A group is one task's frame, so ``keys`` must bound it: window
    aggregates of a range by series, or points by series and slot. Only ``columns`` are sent.
    """
    find_package(df.sparkSession)

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        found = fit(frame[columns])
        return pd.DataFrame([[*key, json.dumps(found) if found is not None else None, len(frame)]], columns=[*keys, "parameters", "n"])

    rows = df.select(*keys, *[c for c in columns if c not in keys])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "parameters string, n bigint"])
    return rows.groupBy(*keys).applyInPandas(one, schema)


def predict_with(
    df: DataFrame, models: DataFrame, predict: Callable[[dict, pd.DataFrame], pd.DataFrame], output: str, keys: list[str], slot=None
) -> DataFrame:
    """Rows with the columns of ``output`` that their group's model adds; null where a group has no model.

    Rows are cogrouped with their model. ``slot``, a column such as ``slot_of()``, cuts the rows of a group into parts that several
    tasks predict, each with a copy of the model, so that no group of rows has to fit one task.
    """
    find_package(df.sparkSession)
    cut = "__slot"
    rows = df.withColumn(cut, slot if slot is not None else F.lit(0))
    parts = rows.select(*keys, cut).distinct()
    same = reduce(and_, [F.col(f"m.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys])
    joined = parts.alias("p").join(models.select(*keys, "parameters").alias("m"), same)
    own = [f"__key_{i}" for i in range(len(keys))]
    copies = joined.select(*[F.col(f"p.{k}").alias(name) for k, name in zip(keys, own)], F.col(f"p.{cut}").alias("__part"), "m.parameters")
    added = [part.split()[0].strip("`") for part in output.split(",")]
    names = [*df.columns, *added]

    def one(frame: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        text = model["parameters"].iloc[0] if len(model) else None
        known = text is not None and len(frame)
        out = predict(json.loads(text), frame) if known else frame.assign(**{c: None for c in added})
        return out[names]

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], output])
    return rows.groupBy(*keys, cut).cogroup(copies.groupBy(*own, "__part")).applyInPandas(one, schema)


class _GroupParams(Described):
    model = Param(Params._dummy(), "model", "registered name or module.Class of a pandas model", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "columns that tell groups apart", TypeConverters.toListString)
    columns = Param(Params._dummy(), "columns", "columns the model is fitted on", TypeConverters.toListString)
    slot = Param(Params._dummy(), "slot", "width of the time slots in which rows are predicted; none if empty", TypeConverters.toString)


class GroupModels(_GroupParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fit a pandas model for every group of one frame."""

    @keyword_only
    def __init__(self, *, model=None, keys=None, columns=None, slot=None):
        super().__init__()
        self._setDefault(keys=[BUCKET], columns=[VALUE], slot="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FittedGroups:
        get = self.getOrDefault
        table = fit_groups(dataset, model_class(get(self.model)).fit, get(self.keys), get(self.columns))
        path = scratch_path(dataset.sparkSession, "group-models")
        table.write.parquet(path)
        return self._copyValues(FittedGroups(dataset.sparkSession.read.parquet(path)))


class FittedGroups(_GroupParams, Model, MLWritable, MLReadable):
    """A table of fitted models; predicts each row by its group's."""

    def __init__(self, stats: DataFrame | None = None):
        super().__init__()
        self._setDefault(keys=[BUCKET], columns=[VALUE], slot="")
        self.stats = stats

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        cls = model_class(get(self.model))
        slot = slot_of(width=get(self.slot)) if get(self.slot) else None
        return predict_with(dataset, self.stats, cls.predict, cls.OUTPUT, get(self.keys), slot)

    def results(self, df: DataFrame) -> dict[str, DataFrame]:
        return {"models": self.stats}

    def write(self) -> MLWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls)


class _RegressionParams(Described):
    features = Param(Params._dummy(), "features", "columns that explain", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "column to explain", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "columns that tell groups apart", TypeConverters.toListString)


class GroupRegression(_RegressionParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares with an intercept for every group, of any number of rows."""

    @keyword_only
    def __init__(self, *, features=None, label=None, keys=None):
        super().__init__()
        self._setDefault(label=VALUE, keys=[BUCKET])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> GroupRegressionModel:
        get = self.getOrDefault
        sums = gram_sums(dataset, get(self.keys), get(self.features), get(self.label))
        path = scratch_path(dataset.sparkSession, "gram-sums")
        sums.write.parquet(path)
        return self._copyValues(GroupRegressionModel(dataset.sparkSession.read.parquet(path)))


class GroupRegressionModel(_RegressionParams, Model, MLWritable, MLReadable):
    """What least squares found per group, as sums that further batches are added to."""

    def __init__(self, stats: DataFrame | None = None):
        super().__init__()
        self._setDefault(label=VALUE, keys=[BUCKET])
        self.stats = stats

    def learned(self) -> DataFrame:
        return coefficients(self.stats, self.getOrDefault(self.keys), self.getOrDefault(self.features))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keys, features = self.getOrDefault(self.keys), self.getOrDefault(self.features)
        names = {k: f"__key_{i}" for i, k in enumerate(keys)}
        found = self.learned().select(*[F.col(k).alias(n) for k, n in names.items()], "intercept", "coefficients")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        return dataset.join(found, same, "left").select(*dataset.columns, fitted_value(features).alias("prediction"))

    def partial_fit(self, df: DataFrame) -> GroupRegressionModel:
        """A model that has also seen ``df``; earlier rows are not needed."""
        get = self.getOrDefault
        seen = self.stats.unionByName(gram_sums(df, get(self.keys), get(self.features), get(self.label)))
        return self._copyValues(GroupRegressionModel(merged_sums(seen, get(self.keys), get(self.features))))

    def results(self, df: DataFrame) -> dict[str, DataFrame]:
        return {"learned": self.learned()}

    def write(self) -> MLWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls)
