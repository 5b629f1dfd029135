"""Build, fit, save, load and run chains of stages described by plans."""

from __future__ import annotations

import importlib
import json
import warnings
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from chronoloom.operators.fuse import fuse
from chronoloom.plans.models import GroupModels, GroupRegression
from chronoloom.plans.plan import Source, filled_sources, load_sources
from chronoloom.plans.stages import Centre, Fuse, LagFeatures, Synchronise

REGISTRY: dict[str, type] = {c.__name__: c for c in (Fuse, Synchronise, LagFeatures, Centre, GroupModels, GroupRegression)}


CONCURRENT_FITS = 4


class InsufficientData(ValueError):
    """A plan whose sources gave no rows to fit on."""


@dataclass
class Pipe:
    """A fitted chain with what it was trained on."""

    name: str
    model: PipelineModel
    training_info: Mapping = field(default_factory=dict)
    date: str = ""

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def results(self, df: DataFrame) -> list[dict[str, DataFrame]]:
        """The results of every stage that has any, in order."""
        found = []
        for stage in self.model.stages:
            df = stage.transform(df)
            if hasattr(stage, "results"):
                found.append(stage.results(df))
        return found

    def update(self, **values) -> None:
        for stage in self.model.stages:
            if hasattr(stage, "update"):
                stage.update(**values)
            else:
                warnings.warn(f"{type(stage).__name__} takes no updates", stacklevel=2)

    def release(self) -> None:
        """Let every stage go of what it holds in memory."""
        for stage in self.model.stages:
            if hasattr(stage, "release"):
                stage.release()

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Predictions of the last stage with a probability, of the frame the stages before it give."""
        *before, last = self.model.stages
        if not hasattr(last, "predict_proba"):
            raise TypeError(f"{type(last).__name__} gives no probability")
        for stage in before:
            df = stage.transform(df)
        return last.predict_proba(df)

    def info(self) -> dict[str, str]:
        return {s.uid: s.info() if hasattr(s, "info") else type(s).__name__ for s in self.model.stages}

    def attributes(self) -> dict[str, dict]:
        """Parameters of every stage, and the plain attributes of those that show them."""
        own = lambda s: {p.name: s.getOrDefault(p) for p in s.params if s.isDefined(p)}
        return {s.uid: s.attributes() if hasattr(s, "attributes") else own(s) for s in self.model.stages}

    def files(self) -> dict[str, str | None]:
        """The file that defines each stage of the library or of a user."""
        return {s.uid: s.source_file() for s in self.model.stages if hasattr(s, "source_file")}

    def matrices(self, df: DataFrame) -> dict[str, dict[str, tuple[list[str], int]]]:
        """Columns and row counts of every result frame, by stage."""
        named = zip([s.uid for s in self.model.stages if hasattr(s, "results")], self.results(df))
        return {uid: {name: (frame.columns, frame.count()) for name, frame in found.items()} for uid, found in named}


def register(cls: type, name: str | None = None) -> type:
    """Make a stage class available to plans under its name."""
    REGISTRY[name or cls.__name__] = cls
    return cls


def make_stage(name: str, params: Mapping, package: str | None = None):
    """A stage by registered name, or by ``module.Class`` within a package of user stages, which comes first."""
    cls = REGISTRY.get(name)
    if cls is None and package is not None and "." in name:
        module, attribute = name.rsplit(".", 1)
        cls = getattr(importlib.import_module(f"{package}.{module}"), attribute)
    if cls is None and package is None:
        cls = REGISTRY.get(name.rsplit(".", 1)[-1])
    if cls is None:
        raise ValueError(f"unknown stage {name!r}; registered: {sorted(REGISTRY)}")
    return cls(**params)


def build_pipeline(steps: Mapping[str, Mapping], package: str | None = None) -> Pipeline:
    """The chain of a plan, in the order its steps are written."""
    return Pipeline(stages=[make_stage(name, params, package) for name, params in steps.items()])


def prepare_data(
    spark: SparkSession, queries: Mapping, stages, sources: Mapping[str, Source], start=None, stop=None, source: str | None = None
) -> DataFrame:
    """The frame of filled-in queries, for training and prediction alike.

    Sources are combined by the chain's last fusing stage, if it has one. ``source`` names the one
    source to take instead of all of them.
    """
    if source is not None and source not in queries:
        raise ValueError(f"no source {source!r} in the plan; it has {sorted(queries)}")
    wanted = queries if source is None else {source: queries[source]}
    frames = load_sources(spark, {"data_sources": wanted}, sources, start, stop)
    if not frames:
        raise InsufficientData("no data source gave a frame")
    fusers = [s for s in stages if isinstance(s, Fuse)]
    return fusers[-1].fuse(frames) if fusers else fuse(frames.values())


def fit_pipe(name: str, pipeline: Pipeline, df: DataFrame, training_info: Mapping | None = None) -> Pipe:
    if df.isEmpty():
        raise InsufficientData(f"no rows to fit {name!r} on")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return Pipe(name, pipeline.fit(df), training_info or {}, date)


def fit_predict(name: str, pipeline: Pipeline, df: DataFrame, training_info: Mapping | None = None):
    """Fit, then predict the same rows; the pipe and its predictions."""
    pipe = fit_pipe(name, pipeline, df, training_info)
    return pipe, pipe.predict(df)


def fit_plans(
    spark: SparkSession, plan: Mapping, sources: Mapping[str, Source], package: str | None = None
) -> dict[str, Pipe]:
    """Fit every entry of a plan, several at a time; entries without data are left out.

    A pipe keeps its queries with their parameters filled in, so that it can predict without the plan.
    """

    def fitted(item: tuple[str, Mapping]) -> Pipe | None:
        name, entry = item
        pipeline = build_pipeline(entry["steps"], package)
        queries = filled_sources(entry)
        try:
            return fit_pipe(name, pipeline, prepare_data(spark, queries, pipeline.getStages(), sources), queries)
        except InsufficientData:
            return None

    with ThreadPoolExecutor(CONCURRENT_FITS) as pool:
        return {pipe.name: pipe for pipe in pool.map(fitted, plan.items()) if pipe is not None}


def predict_range(
    spark: SparkSession, pipe: Pipe, sources: Mapping[str, Source], start, stop, source: str | None = None
) -> DataFrame:
    """Predict over another time range of the data the pipe was trained on, all of it or one named source.

    All buckets go through as one frame with a bucket column; stages keep them apart by key.
    """
    return pipe.predict(prepare_data(spark, pipe.training_info, pipe.model.stages, sources, start, stop, source))


def save_pipe(spark: SparkSession, pipe: Pipe, path: str) -> None:
    pipe.model.write().overwrite().save(f"{path}/model")
    record = {"name": pipe.name, "training_info": pipe.training_info, "date": pipe.date}
    spark.createDataFrame([(json.dumps(record, default=str),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/record")


def load_pipe(spark: SparkSession, path: str) -> Pipe:
    record = json.loads(spark.read.text(f"{path}/record").first()[0])
    return Pipe(record["name"], PipelineModel.load(f"{path}/model"), record["training_info"], record["date"])
