"""Fitted models on streaming tables.

Models whose ``preprocess`` is made of row expressions and joins with static tables work on
``readStream`` frames as they are. Those that order records inside a group do not: a stream has no
last record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from maskloom.operators.processors import (
    DatetimeProcessor,
    PerturbationProcessor,
    ProportionProcessor,
)
from maskloom.operators.processors.categorical import ToCategoricalModel
from maskloom.operators.processors.geolocation import GeolocationModel
from maskloom.operators.processors.modalities import GroupModalitiesModel
from maskloom.plans.pipeline import PipelineModel

ROW_LOCAL = (
    DatetimeProcessor, GeolocationModel, GroupModalitiesModel, PerturbationProcessor,
    ProportionProcessor, ToCategoricalModel,
)


def preprocess_stream(model, stream: DataFrame) -> DataFrame:
    """Apply a model fitted on a static table to a streaming table."""
    stages = model.models if isinstance(model, PipelineModel) else (model,)
    blocked = [type(m).__name__ for m in stages if not isinstance(m, ROW_LOCAL)]
    if blocked:
        raise ValueError(f"{blocked} need whole groups and cannot run on a stream")
    return model.preprocess(stream)
