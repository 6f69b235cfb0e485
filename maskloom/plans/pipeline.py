"""Chains of processors: forward in order, backward in reverse order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from maskloom.operators.processors.base import Model, Processor


@dataclass(frozen=True)
class PipelineModel:
    """``sources[i]`` is the table stage ``i`` was fitted on: the source its inverse refers to."""

    models: tuple[Model, ...]
    sources: tuple[DataFrame, ...]

    def preprocess(self, df: DataFrame) -> DataFrame:
        for model in self.models:
            df = model.preprocess(df)
        return df

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        stages = [source]
        for model in self.models[:-1]:
            stages.append(model.preprocess(stages[-1]))
        for model, before in zip(reversed(self.models), reversed(stages)):
            dest = model.postprocess(before, dest)
        return dest


@dataclass(frozen=True)
class Pipeline:
    processors: Sequence[Processor]

    def fit(self, df: DataFrame) -> PipelineModel:
        """Each processor is fitted on what the earlier ones produce."""
        models, sources = [], []
        for processor in self.processors:
            model = processor.fit(df)
            models.append(model)
            sources.append(df)
            df = model.preprocess(df)
        return PipelineModel(tuple(models), tuple(sources))
