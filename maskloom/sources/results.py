"""Result catalogue of a run: one folder per (table, result)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Names of the results of a run.
TABLE_RESULTS = (
    "shuffled", "unshuffled", "privacy_metrics", "signal_metrics", "original_projections",
    "synthetic_projections", "advice", "figures", "privacy_budget",
)
RUN_RESULTS = ("meta_privacy_metric", "meta_signal_metric", "run_metadata")
METRIC_RESULTS = ("privacy_metrics", "signal_metrics", "meta_privacy_metric", "meta_signal_metric")
METRIC_SCHEMA = (
    "table_name string, computation_type string, reference string, metric string, value double"
)


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON, one record per line."""
    df.write.mode(mode).json(path)


def read_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records from JSON lines, a JSON array, or a single object (read as one record)."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", _is_document(spark, path)).json(path)


def _is_document(spark: SparkSession, path: str) -> bool:
    """True when the text starts a value that its first line does not close."""
    head = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
    first = head[0]["value"].strip() if head else ""
    try:
        return isinstance(json.loads(first), list)
    except ValueError:
        return True


@dataclass(frozen=True)
class RunResult:
    """DataFrames of one run: per table by result name, and those of the run as a whole."""

    tables: Mapping[str, Mapping[str, DataFrame]]
    run: Mapping[str, DataFrame] = field(default_factory=dict)

    def get(self, table: str, result: str) -> DataFrame:
        if result not in TABLE_RESULTS and not result.startswith("figures"):
            raise ValueError(f"Expected a result among {TABLE_RESULTS}, got {result!r} instead")
        if table not in self.tables:
            raise ValueError(f"Expected a table among {sorted(self.tables)}, got {table!r} instead")
        if result not in self.tables[table]:
            raise ValueError(f"table {table!r} has no result {result!r}")
        return self.tables[table][result]

    def shuffled(self, table: str) -> DataFrame:
        return self.get(table, "shuffled")

    def unshuffled(self, table: str) -> DataFrame:
        return self.get(table, "unshuffled")

    def privacy_metrics(self, table: str) -> DataFrame:
        return self.get(table, "privacy_metrics")

    def signal_metrics(self, table: str) -> DataFrame:
        return self.get(table, "signal_metrics")

    def projections(self, table: str) -> tuple[DataFrame, DataFrame]:
        return self.get(table, "original_projections"), self.get(table, "synthetic_projections")

    def write(self, folder: str, mode: str = "errorifexists") -> None:
        """Metrics as JSON records, everything else as parquet."""
        for table, results in self.tables.items():
            for name, df in results.items():
                _write(df, name, f"{folder}/{table}/{name}", mode)
        for name, df in self.run.items():
            _write(df, name, f"{folder}/_run/{name}", mode)

    @staticmethod
    def read(
        spark: SparkSession, folder: str, contents: Mapping[str, list[str]], run: list[str] = ()
    ) -> RunResult:
        """Open what ``contents`` names per table; nothing is scanned until it is used."""
        tables = {
            t: {n: _read(spark, n, f"{folder}/{t}/{n}") for n in names}
            for t, names in contents.items()
        }
        return RunResult(tables, {n: _read(spark, n, f"{folder}/_run/{n}") for n in run})


def _write(df: DataFrame, name: str, path: str, mode: str) -> None:
    if name in METRIC_RESULTS:
        write_records(df, path, mode)
    else:
        df.write.mode(mode).parquet(path)


def _read(spark: SparkSession, name: str, path: str) -> DataFrame:
    if name in ("privacy_metrics", "signal_metrics"):
        return spark.read.schema(METRIC_SCHEMA).json(path)
    if name in METRIC_RESULTS:
        return spark.read.json(path)
    return spark.read.parquet(path)
