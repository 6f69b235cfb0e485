"""Reversible table processors: ``fit(df)`` gives a model with ``preprocess`` and ``postprocess``."""

from maskloom.operators.processors.base import Model, Processor
from maskloom.operators.processors.bounded import (
    InterRecordBoundedCumulatedDifferenceProcessor,
    InterRecordBoundedRangeDifferenceProcessor,
)
from maskloom.operators.processors.categorical import ToCategoricalProcessor
from maskloom.operators.processors.datetime import DatetimeProcessor
from maskloom.operators.processors.geolocation import GeolocationNormalizationProcessor
from maskloom.operators.processors.mean import ExpectedMeanProcessor
from maskloom.operators.processors.modalities import GroupModalitiesProcessor
from maskloom.operators.processors.perturbation import PerturbationProcessor
from maskloom.operators.processors.proportion import (
    ProportionProcessor,
    RelativeDifferenceProcessor,
)
from maskloom.operators.processors.records import (
    InterRecordCumulatedDifferenceProcessor,
    InterRecordRangeDifferenceProcessor,
)

__all__ = [
    "DatetimeProcessor",
    "ExpectedMeanProcessor",
    "GeolocationNormalizationProcessor",
    "GroupModalitiesProcessor",
    "InterRecordBoundedCumulatedDifferenceProcessor",
    "InterRecordBoundedRangeDifferenceProcessor",
    "InterRecordCumulatedDifferenceProcessor",
    "InterRecordRangeDifferenceProcessor",
    "Model",
    "PerturbationProcessor",
    "Processor",
    "ProportionProcessor",
    "RelativeDifferenceProcessor",
    "ToCategoricalProcessor",
]
