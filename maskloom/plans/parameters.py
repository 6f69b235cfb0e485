"""Parameters per table: set, change in part, delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields, replace

from maskloom.operators.synthesis.generate import COORDINATE_SIMILARITY, ROW_ORDER
from maskloom.operators.synthesis.impute import FAST_KNN, METHODS
from maskloom.operators.timeseries import ALIGNMENTS, FPCA, MAX, PROJECTIONS


@dataclass(frozen=True)
class Parameters:
    """Synthesis and metric parameters of one table; ``k`` and ``dp_epsilon`` exclude each other."""

    k: int | None = None
    ncp: int | None = 5
    use_categorical_reduction: bool = False
    column_weights: Mapping[str, float] = field(default_factory=dict)
    exclude_variable_names: Sequence[str] = ()
    exclude_replacement_strategy: str = ROW_ORDER
    imputation_method: str = FAST_KNN
    imputation_k: int = 5
    imputation_training_fraction: float = 1.0
    dp_epsilon: float | None = None
    dp_preprocess_budget_ratio: float = 0.5
    dp_bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    dp_modalities: Mapping[str, Sequence[str]] = field(default_factory=dict)
    dp_missing: Sequence[str] = ()
    time_series_nf: int = 3
    time_series_projection_type: str = FPCA
    time_series_nb_points: int | None = None
    time_series_method: str = MAX
    known_variables: Sequence[str] = ()
    target: str | None = None
    closest_rate_percentage_threshold: float = 0.05
    closest_rate_ratio_threshold: float = 0.5
    categorical_hidden_rate_variables: Sequence[str] = ()
    seed: int = 0

    def __post_init__(self) -> None:
        if self.k and self.dp_epsilon:
            raise ValueError(
                "Expected either k or dp_epsilon to be set, not both. "
                "If you want to use differential privacy, set dp_epsilon and remove k."
            )
        for name, allowed in (
            ("imputation_method", METHODS),
            ("exclude_replacement_strategy", (ROW_ORDER, COORDINATE_SIMILARITY)),
            ("time_series_projection_type", PROJECTIONS),
            ("time_series_method", ALIGNMENTS),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"Expected {name} among {allowed}, got {getattr(self, name)!r} instead")


@dataclass(frozen=True)
class ParameterSet:
    """Parameters by table name; every change returns a new set."""

    tables: Mapping[str, Parameters] = field(default_factory=dict)

    def set(self, table: str, **values) -> ParameterSet:
        """Replace all parameters of a table."""
        return ParameterSet({**self.tables, table: Parameters(**values)})

    def update(self, table: str, **values) -> ParameterSet:
        """Change the given parameters and keep the others."""
        known = {f.name for f in fields(Parameters)}
        unknown = set(values) - known
        if unknown:
            raise ValueError(f"Expected parameters among {sorted(known)}, got {sorted(unknown)} instead")
        return ParameterSet(
            {**self.tables, table: replace(self.tables.get(table, Parameters()), **values)}
        )

    def delete(self, table: str) -> ParameterSet:
        return ParameterSet({t: p for t, p in self.tables.items() if t != table})

    def get(self, table: str) -> Parameters:
        if table not in self.tables:
            raise ValueError(f"Expected parameters for table {table!r}")
        return self.tables[table]
