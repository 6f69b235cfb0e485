"""Tables, links and data sets."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from maskloom.operators.multitable import LINEAR_SUM_ASSIGNMENT, LINK_METHODS
from maskloom.operators.profile import infer_types
from maskloom.sources.tables import read_table


@dataclass(frozen=True)
class TableSpec:
    """A table with its role. ``synthetic_data`` is an already made, row-aligned twin."""

    name: str
    data: DataFrame
    primary_key: str | None = None
    foreign_keys: tuple[str, ...] = ()
    time_series_time: str | None = None
    types: Mapping[str, str] = field(default_factory=dict)
    individual_level: bool = False
    synthetic_data: DataFrame | None = None

    def __post_init__(self) -> None:
        named = [self.primary_key, self.time_series_time, *self.foreign_keys]
        unknown = [c for c in named if c and c not in self.data.columns]
        if unknown:
            raise ValueError(f"table {self.name!r} has no columns {unknown}")

    @property
    def keys(self) -> tuple[str, ...]:
        own = (self.primary_key,) if self.primary_key else ()
        return (*own, *(c for c in self.foreign_keys if c not in own))


@dataclass(frozen=True)
class LinkSpec:
    parent_table: str
    parent_field: str
    child_table: str
    child_field: str
    method: str = LINEAR_SUM_ASSIGNMENT

    def __post_init__(self) -> None:
        if self.method not in LINK_METHODS:
            raise ValueError(f"Expected a method among {LINK_METHODS}, got {self.method!r} instead")


@dataclass(frozen=True)
class DatasetSpec:
    """Immutable; every change returns a new data set."""

    name: str
    tables: Mapping[str, TableSpec] = field(default_factory=dict)
    links: tuple[LinkSpec, ...] = ()

    def add_table(
        self,
        name: str,
        data: DataFrame | str,
        *,
        spark: SparkSession | None = None,
        synthetic_data: DataFrame | str | None = None,
        types: Mapping[str, str] | None = None,
        **roles,
    ) -> DatasetSpec:
        """Add a DataFrame or a path. Types are inferred from the schema, ``types`` win."""
        if isinstance(data, str) and spark is None:
            spark = SparkSession.active()
        frame = read_table(spark, data)
        twin = read_table(spark or frame.sparkSession, synthetic_data) if synthetic_data is not None else None
        spec = TableSpec(name, frame, types=infer_types(frame, types), synthetic_data=twin, **roles)
        return replace(self, tables={**self.tables, name: spec})

    def add_link(
        self,
        parent_table_name: str,
        parent_field: str,
        child_table_name: str,
        child_field: str,
        method: str = LINEAR_SUM_ASSIGNMENT,
    ) -> DatasetSpec:
        for table, column in ((parent_table_name, parent_field), (child_table_name, child_field)):
            if table not in self.tables:
                raise ValueError(f"Expected a table among {sorted(self.tables)}, got {table!r} instead")
            if column not in self.tables[table].data.columns:
                raise ValueError(f"table {table!r} has no column {column!r}")
        link = LinkSpec(parent_table_name, parent_field, child_table_name, child_field, method)
        return replace(self, links=(*self.links, link))

    def drop_table(self, name: str) -> DatasetSpec:
        kept = {n: t for n, t in self.tables.items() if n != name}
        links = tuple(x for x in self.links if name not in (x.parent_table, x.child_table))
        return replace(self, tables=kept, links=links)

    def drop_links(self, child_table: str) -> DatasetSpec:
        return replace(self, links=tuple(x for x in self.links if x.child_table != child_table))

    def parents_of(self, child: str) -> list[LinkSpec]:
        return [x for x in self.links if x.child_table == child]

    def children_of(self, parent: str) -> list[LinkSpec]:
        return [x for x in self.links if x.parent_table == parent]

    def parents_first(self) -> list[str]:
        """Table names so that every parent comes before its children."""
        ordered: list[str] = []
        waiting = list(self.tables)
        while waiting:
            ready = [
                t for t in waiting if all(x.parent_table in ordered for x in self.parents_of(t))
            ]
            if not ready:
                raise ValueError(f"links between {waiting} form a cycle")
            ordered += ready
            waiting = [t for t in waiting if t not in ready]
        return ordered

    def validate(self) -> None:
        """Keys present where links need them, and childless tables describe individuals."""
        for link in self.links:
            child, parent = self.tables[link.child_table], self.tables[link.parent_table]
            if parent.primary_key != link.parent_field:
                raise ValueError(
                    f"link to {link.parent_table!r} uses {link.parent_field!r}, "
                    f"not its primary key {parent.primary_key!r}"
                )
            if link.child_field not in child.keys and link.method != "time_series":
                raise ValueError(f"{link.child_field!r} is not a key of table {link.child_table!r}")
