"""Protocol of a reversible table processor."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame


@runtime_checkable
class Model(Protocol):
    """Fitted, immutable state of a processor."""

    def preprocess(self, df: DataFrame) -> DataFrame: ...

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame: ...


@runtime_checkable
class Processor(Protocol):
    """Anything with ``fit``; user classes may use pandas UDFs inside their model."""

    def fit(self, df: DataFrame) -> Model: ...
