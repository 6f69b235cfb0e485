"""End-to-end run over a data set: synthesis, then utility metrics, then privacy metrics."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.functions.sizing import lookup
from maskloom.functions.validation import col, is_number
from maskloom.operators import multitable as mt
from maskloom.operators import timeseries as ts
from maskloom.operators.metrics import privacy, signal
from maskloom.operators.ordinal import hash_ordinal
from maskloom.operators.synthesis.advise import advise
from maskloom.operators.synthesis.generate import (
    Synthesis,
    attach_excluded,
    neighbor_weights,
    shuffle_rows,
    synthesize,
)
from maskloom.operators.assignment import assign_parents
from maskloom.operators.synthesis.impute import MODE, impute
from maskloom.operators.synthesis.noise import budget_ledger, private_rows
from maskloom.operators.synthesis.project import Space, fit_space
from maskloom.operators.synthesis.sparse import SparseSpace
from maskloom.plans.parameters import Parameters, ParameterSet
from maskloom.plans.specs import DatasetSpec, LinkSpec, TableSpec
from maskloom.session import materialize
from maskloom.sources.results import METRIC_SCHEMA, RunResult

STANDALONE = "standalone"
TO_TOP_ENRICHED = "to_top_enriched"
TO_BOTTOM_ID = "to_bottom_id_propagated"
TO_BOTTOM_INFORMATION = "to_bottom_information_propagated"
FULL_ENRICHED = "full_enriched"

# Fixed value: stages run in this order whatever the order of the request.
STAGES = ("synthesis", "signal_metrics", "privacy_metrics")


@dataclass(frozen=True)
class Twin:
    """A table and its row-aligned synthetic rows, with their coordinates in one space."""

    key: str
    columns: tuple[str, ...]
    source: DataFrame
    unshuffled: DataFrame
    originals: DataFrame
    placed: DataFrame
    synthesis: Synthesis | None = None
    space: Space | SparseSpace | None = None
    individuals: DataFrame | None = None


def row_key_of(spec: TableSpec) -> str:
    if not spec.primary_key:
        raise ValueError(f"table {spec.name!r} needs a primary key: rows are matched by key")
    return spec.primary_key


def twin_from_pair(source: DataFrame, synthetic: DataFrame, key: str, p: Parameters) -> Twin:
    """Metrics on a user's own pair of tables: nothing is synthesised."""
    columns = tuple(c for c in source.columns if c != key)
    filled = impute(source, columns, method=MODE, row_key=key)
    other = impute(synthetic, columns, method=MODE, row_key=key, reference=source)
    space = fit_space(
        filled, columns, row_key=key, ncp=p.ncp, weights=p.column_weights,
        use_categorical_reduction=p.use_categorical_reduction,
    )
    return Twin(
        key, columns, source, synthetic, materialize(space.place(filled, key)),
        materialize(space.place(other, key)), space=space,
    )


def synthesize_table(spec: TableSpec, p: Parameters) -> Twin:
    key = row_key_of(spec)
    excluded = [c for c in p.exclude_variable_names if c in spec.data.columns]
    linked = [c for c in spec.foreign_keys if c != key]
    used = [c for c in spec.data.columns if c not in {key, *excluded, *linked}]
    if spec.synthetic_data is not None:
        pair = spec.data.select(col(key), *map(col, used))
        return twin_from_pair(pair, spec.synthetic_data.select(col(key), *map(col, used)), key, p)
    if p.dp_epsilon:
        bare = [c for c in used if c not in p.dp_bounds and c not in p.dp_modalities]
        if bare:
            raise ValueError(
                f"Expected dp_bounds or dp_modalities for {', '.join(bare)} of table {spec.name!r}, "
                "or these columns among exclude_variable_names"
            )
        private = private_rows(
            spec.data.drop(*excluded), key, epsilon=p.dp_epsilon, bounds=p.dp_bounds, modalities=p.dp_modalities,
            preprocess_budget_ratio=p.dp_preprocess_budget_ratio, missing=p.dp_missing, seed=p.seed,
        )
        private = materialize(private)
        pair = spec.data.select(*map(col, private.columns))
        return twin_from_pair(pair, private, key, p)
    if not p.k:
        raise ValueError(f"Expected k or dp_epsilon for table {spec.name!r}")
    made = synthesize(
        spec.data, key, k=p.k, ncp=p.ncp, columns=used, column_weights=p.column_weights,
        use_categorical_reduction=p.use_categorical_reduction,
        imputation_method=p.imputation_method, imputation_k=p.imputation_k,
        imputation_training_fraction=p.imputation_training_fraction, seed=p.seed,
    )
    rows = made.unshuffled
    if excluded:
        rows = materialize(attach_excluded(
            made, spec.data, excluded, strategy=p.exclude_replacement_strategy
        ))
    placed = materialize(made.place(made.unshuffled))
    return Twin(key, tuple(used), made.source, rows, made.originals, placed, made, made.space)


@dataclass(frozen=True)
class Series:
    """A table of series, its synthetic rows, and one coordinate row per individual for either."""

    key: str
    columns: tuple[str, ...]
    source: DataFrame
    unshuffled: DataFrame
    originals: DataFrame
    placed: DataFrame


def synthesize_series(
    tables: Sequence[tuple[TableSpec, LinkSpec, Parameters]], parent: TableSpec, p: Parameters
) -> tuple[Twin, dict[str, Series]]:
    """Individuals and all their series together.

    Every number of every series becomes ``time_series_nf`` scores next to the individual's columns;
    the neighbours and weights found there mix both the individual rows and the aligned series.
    """
    enriched, fitted = parent.data, {}
    for spec, link, q in tables:
        ident, time = link.child_field, spec.time_series_time
        own = [f for f in spec.data.schema.fields if f.name not in {ident, time, *spec.keys}]
        values = [f.name for f in own if is_number(f)]
        carried = [f.name for f in own if not is_number(f)]
        n = ts.common_length(spec.data, ident, q.time_series_method, q.time_series_nb_points)
        aligned = materialize(ts.align(
            spec.data, ident, time, values, row_key_of(spec), method=ts.SPECIFIED, nb_points=n,
            carried=carried,
        ))
        models = {}
        for i, value in enumerate(values):
            scores, models[value] = ts.series_scores(
                aligned, ident, [value], n, projection=q.time_series_projection_type, nf=q.time_series_nf
            )
            enriched = materialize(ts.attach_scores(
                enriched, row_key_of(parent), scores, ident, min(q.time_series_nf, n),
                prefix=f"__score_{len(fitted)}_{i}",
            ))
        fitted[spec.name] = (spec, ident, time, values, carried, n, aligned, models, q)
    twin = synthesize_table(replace(parent, data=enriched), p)
    if twin.synthesis is None:
        raise ValueError("series need their individuals to be synthesised with k")
    weights = neighbor_weights(twin.synthesis.neighbors, p.seed)
    made = {}
    for name, (spec, ident, time, values, carried, n, aligned, models, q) in fitted.items():
        mixed = materialize(ts.weighted_series(weights, aligned, ident, [time, *values], carried))
        rows = ts.rebuild(mixed, ident, time, spec.data)
        pair = F.concat_ws("/", col(ident).cast("string"), F.col("point").cast("string"))
        rows = hash_ordinal(rows.withColumn("__pair", pair), "__pair", seed=p.seed, stream=name, output="__new")
        key = spec.primary_key
        rows = rows.withColumn(key, F.col("__new").cast(spec.data.schema[key].dataType))
        order = [c for c in spec.data.columns if c in rows.columns]
        made[name] = Series(
            ident, (*values, *carried), spec.data, materialize(rows.select(*map(col, order), "point")),
            *[materialize(series_places(x, ident, models)) for x in (aligned, mixed)])
    return twin, made


def series_places(aligned: DataFrame, ident: str, models: dict) -> DataFrame:
    """(ident, features): the scores of all numbers of a series in one array."""
    out = None
    for value, components in models.items():
        scores = components.place(aligned, ident).select(col(ident), F.col("features").alias("__f"))
        if out is None:
            out = scores.withColumnRenamed("__f", "features")
        else:
            out = out.join(scores, ident).select(col(ident), F.concat("features", "__f").alias("features"))
    return out


def series_signal(made: Series) -> dict[str, float]:
    return signal_values(made.source, made.unshuffled, made.columns)


def series_privacy(made: Series, p: Parameters) -> dict[str, float]:
    """Distances between the series of individuals; row matches make no sense on mixed times."""
    return distance_values(made.originals, made.placed, made.key, p)


def metric_records(
    spark: SparkSession, table: str, kind: str, reference: str | None, values: dict[str, float]
) -> DataFrame:
    rows = [
        (table, kind, reference, name, None if v is None else float(v))
        for name, v in values.items()
    ]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def signal_values(source: DataFrame, synthetic: DataFrame, columns: Sequence[str]) -> dict:
    out = signal.hellinger(source, synthetic, columns)
    if sum(is_number(source.schema[c]) for c in columns) > 1:
        out["correlation_difference_ratio"] = signal.correlation_difference_ratio(
            source, synthetic, columns
        )
    return out


def distance_values(a: DataFrame, b: DataFrame, key: str, p: Parameters) -> dict[str, float]:
    """Privacy metrics that need only the coordinates of originals and synthetic rows."""
    closest = materialize(privacy.closest_distances(a, b, key))
    return {
        "hidden_rate": privacy.hidden_rate(a, b, key),
        "local_cloaking": privacy.local_cloaking(a, b, key),
        **privacy.distance_to_closest(closest),
        "nndr": privacy.nearest_neighbor_ratio(closest),
        "closest_rate": privacy.closest_rate(
            a, closest, key, percentage_threshold=p.closest_rate_percentage_threshold,
            ratio_threshold=p.closest_rate_ratio_threshold,
        ),
    }


def privacy_values(twin: Twin, p: Parameters) -> dict[str, float]:
    out = distance_values(twin.originals, twin.placed, twin.key, p) | {
        "column_direct_match_protection": privacy.column_direct_match_protection(
            twin.source, twin.unshuffled, twin.key, twin.columns
        ),
        "row_direct_match_protection": privacy.row_direct_match_protection(
            twin.source, twin.unshuffled, twin.columns
        ),
    }
    if twin.individuals is not None:
        # a view of a table whose rows are not individuals: exposed is who is found by any of their rows
        out["hidden_rate"] = privacy.hidden_individuals_rate(
            twin.originals, twin.placed, twin.key, twin.individuals)
    if p.categorical_hidden_rate_variables:
        out["categorical_hidden_rate"] = privacy.categorical_hidden_rate(
            twin.source, twin.unshuffled, twin.key, list(p.categorical_hidden_rate_variables)
        )
    if p.known_variables:
        source = impute(twin.source, twin.columns, method=MODE, row_key=twin.key)
        made = impute(twin.unshuffled, twin.columns, method=MODE, row_key=twin.key, reference=twin.source)
        key, known = twin.key, list(p.known_variables)
        others = [c for c in twin.columns if c not in known]
        out["correlation_protection_rate"] = privacy.correlation_protection_rate(
            source, made, key, known, others, ncp=p.ncp
        )
        if p.target:
            continuous = is_number(source.schema[p.target])
            name = "inference_continuous" if continuous else "inference_categorical"
            out[name] = privacy.inference(
                source, made, key, known, p.target, continuous=continuous, ncp=p.ncp
            )
    return out


def link_children(
    dataset: DatasetSpec, twins: dict[str, Twin], name: str, rows: DataFrame
) -> DataFrame:
    """Foreign keys of a synthetic child by the method of each link."""
    spec = dataset.tables[name]
    for link in dataset.parents_of(name):
        if link.method == mt.TIME_SERIES:
            continue
        parent = twins[link.parent_table]
        mapping = None
        if link.method == mt.MINIMUM_DISTANCE_ASSIGNMENT:
            mapping = mt.nearest_parents(parent.originals, parent.placed, parent.key)
        elif link.method == mt.LINEAR_SUM_ASSIGNMENT:
            mapping = assign_parents(parent.originals, parent.placed, parent.key)
        rows = mt.relink(rows, row_key_of(spec), spec.data, link.child_field, mapping)
    return rows


def publish(
    dataset: DatasetSpec, unshuffled: dict[str, DataFrame], keys: dict[str, str], seed: int
) -> dict[str, DataFrame]:
    """Shuffled tables with new keys; foreign keys follow the new keys of their parents."""
    fresh = {
        t: materialize(hash_ordinal(
            df.select(col(keys[t]).alias("__old")), "__old", seed=seed, stream="publish",
            output="__new",
        ))
        for t, df in unshuffled.items() if dataset.children_of(t)
    }
    out = {}
    for t, df in unshuffled.items():
        rows = df
        for link in dataset.parents_of(t):
            if link.parent_table not in fresh or link.child_field not in rows.columns:
                continue
            renamed = fresh[link.parent_table].select(
                F.col("__old").alias(link.child_field), F.col("__new").alias("__fresh")
            )
            joined = lookup(rows, renamed, link.child_field)
            rows = joined.withColumn(link.child_field, F.col("__fresh")).drop("__fresh")
        if t in fresh:
            named = fresh[t].withColumnRenamed("__old", keys[t])
            rows = rows.join(named, keys[t], "inner").withColumn(keys[t], F.col("__new")).drop("__new")
        elif keys.get(t):
            rows = shuffle_rows(rows, keys[t], seed=seed)
        out[t] = rows.select(*map(col, df.columns))
    return out


def enriched_views(
    dataset: DatasetSpec, name: str, rows: dict[str, DataFrame]
) -> list[tuple[str, str | None, DataFrame]]:
    """(computation type, reference, view) beyond the table on its own."""
    spec = dataset.tables[name]
    views = []
    children = [x for x in dataset.children_of(name) if x.method != mt.TIME_SERIES]
    if children:
        described = [
            (x.child_table, rows[x.child_table], x.child_field,
             [c for c in rows[x.child_table].columns if c not in dataset.tables[x.child_table].keys])
            for x in children
        ]
        views.append((TO_TOP_ENRICHED, None, mt.top_enriched(rows[name], spec.primary_key, described)))
    parents = [
        mt.Parent(x.parent_table,
                  rows[x.parent_table].drop(*[
                      c for c in dataset.tables[x.parent_table].foreign_keys if c != x.parent_field
                  ]),
                  x.parent_field, x.child_field)
        for x in dataset.parents_of(name) if x.method != mt.TIME_SERIES
    ]
    for parent in parents:
        views.append((TO_BOTTOM_ID, parent.name, mt.bottom_id_propagated(rows[name], parent.child_field)))
        views.append((
            TO_BOTTOM_INFORMATION, parent.name,
            mt.bottom_information_propagated(rows[name], parent),
        ))
        if len(parents) > 1:
            views.append((FULL_ENRICHED, parent.name, mt.full_enriched(rows[name], parent, parents)))
    return views


def view_twin(
    dataset: DatasetSpec, name: str, source: DataFrame, synthetic: DataFrame, p: Parameters
) -> Twin:
    """Twin of an enriched view; keys do not take part in distances, but say whose rows they are."""
    spec = dataset.tables[name]
    key = row_key_of(spec)
    dropped = {*spec.foreign_keys, "individual_id"} - {key}
    keep = [c for c in source.columns if c not in dropped and c in synthetic.columns]
    weights = {c: w for c, w in p.column_weights.items() if c in keep}
    left, right = materialize(source.select(*map(col, keep))), materialize(synthetic.select(*map(col, keep)))
    twin = twin_from_pair(left, right, key, replace(p, column_weights=weights))
    if "individual_id" not in source.columns:
        return twin
    return replace(twin, individuals=materialize(source.select(col(key), "individual_id")))


def run(
    dataset: DatasetSpec,
    parameters: ParameterSet,
    *,
    stages: Sequence[str] = STAGES,
    multi_table_metrics: bool = True,
    figures: bool = True,
    seed: int = 0,
) -> RunResult:
    """Synthesis, utility metrics and privacy metrics of all tables, in that order.

    With ``figures`` each table also gets the tables behind the usual plots and the advice for it.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"Expected stages among {STAGES}, got {sorted(unknown)} instead")
    dataset.validate()
    spark = next(iter(dataset.tables.values())).data.sparkSession
    twins: dict[str, Twin] = {}
    unshuffled: dict[str, DataFrame] = {}
    series: dict[str, Series] = {}

    for name in dataset.parents_first():
        spec = dataset.tables[name]
        in_time = [x for x in dataset.parents_of(name) if x.method == mt.TIME_SERIES]
        if in_time:
            continue
        timed = [x for x in dataset.children_of(name) if x.method == mt.TIME_SERIES]
        if timed:
            twin, made = synthesize_series(
                [(dataset.tables[x.child_table], x, parameters.get(x.child_table)) for x in timed], spec,
                parameters.get(name),
            )
            series |= made
            unshuffled |= {child: rows.unshuffled for child, rows in made.items()}
            scores = [c for c in twin.unshuffled.columns if c.startswith("__score")]
            twin = replace(
                twin, unshuffled=twin.unshuffled.drop(*scores), source=twin.source.drop(*scores),
                columns=tuple(c for c in twin.columns if c not in scores),
            )
        else:
            twin = synthesize_table(spec, parameters.get(name))
        twins[name] = twin
        unshuffled[name] = materialize(link_children(dataset, twins, name, twin.unshuffled))

    keys = {t: row_key_of(dataset.tables[t]) for t in twins}
    originals = {t: dataset.tables[t].data for t in dataset.tables}
    tables: dict[str, dict[str, DataFrame]] = {t: {} for t in unshuffled}
    published = publish(dataset, unshuffled, keys, seed)
    for t in unshuffled:
        tables[t]["unshuffled"], tables[t]["shuffled"] = unshuffled[t], published[t]
        if t in twins:
            tables[t]["original_projections"] = twins[t].originals
            tables[t]["synthetic_projections"] = twins[t].placed

    views = {}
    if multi_table_metrics and dataset.links:
        for t in twins:
            left = enriched_views(dataset, t, originals)
            right = enriched_views(dataset, t, unshuffled)
            views[t] = [
                (kind, ref, view_twin(dataset, t, a, b, parameters.get(t)))
                for (kind, ref, a), (_, _, b) in zip(left, right)
            ]
    for stage, result in (("signal_metrics", signal_records), ("privacy_metrics", privacy_records)):
        if stage in stages:
            for t, twin in twins.items():
                tables[t][stage] = result(spark, t, twin, views.get(t, []), parameters.get(t))
            for t, made in series.items():
                values = series_signal(made) if stage == "signal_metrics" else series_privacy(made, parameters.get(t))
                tables[t][stage] = metric_records(spark, t, STANDALONE, None, values)
    for t, twin in twins.items():
        p = parameters.get(t)
        if figures:
            tables[t] |= figure_tables(twin)
            tables[t]["advice"] = advise(originals[t], keys[t], t)
        if p.dp_epsilon:
            tables[t]["privacy_budget"] = spark.createDataFrame(budget_ledger(
                epsilon=p.dp_epsilon, bounds=p.dp_bounds, modalities=p.dp_modalities,
                preprocess_budget_ratio=p.dp_preprocess_budget_ratio, missing=p.dp_missing,
            ), "column string, step string, epsilon double")
    whole = {"run_metadata": spark.createDataFrame([
        (dataset.name, t, keys.get(t), ",".join(stages), seed, json.dumps(asdict(parameters.get(t)), default=str))
        for t in tables
    ], "dataset string, table_name string, row_key string, stages string, seed long, parameters string")}
    for stage, meta in (("signal_metrics", "meta_signal_metric"), ("privacy_metrics", "meta_privacy_metric")):
        found = [tables[t][stage] for t in tables if stage in tables[t]]
        if found:
            union = found[0]
            for df in found[1:]:
                union = union.unionByName(df)
            whole[meta] = mt.meta_metrics(union)
    return RunResult(tables, whole)


def figure_tables(twin: Twin) -> dict[str, DataFrame]:
    """The tables behind the usual plots of a table and its synthetic rows."""
    source, made, columns = twin.source, twin.unshuffled, twin.columns
    first = twin.originals.select(F.size("features")).first()
    out = {
        "figures_projections": signal.projection_points(
            twin.originals, twin.placed, twin.key, min(3, first[0] if first else 0)),
        "figures_distributions": signal.distributions(source, made, columns),
    }
    if sum(is_number(source.schema[c]) for c in columns) > 1:
        sides = [signal.correlations(df, columns).withColumn("side", F.lit(side))
                 for df, side in ((source, "original"), (made, "synthetic"))]
        out["figures_correlations"] = sides[0].unionByName(sides[1])
        out["figures_correlation_difference"] = signal.correlation_difference(source, made, columns)
    if any(is_number(source.schema[c]) for c in columns[:10]):
        out["figures_aggregate_stats"] = signal.aggregate_stats(source, made, columns)
    space = twin.space
    if isinstance(space, SparseSpace) or (space and space.projection and not space.reduction):
        out["figures_contributions"] = signal.contributions(source, space)
    return out


def _records(spark, table, twin, views, compute) -> DataFrame:
    out = metric_records(spark, table, STANDALONE, None, compute(twin))
    for kind, reference, view in views:
        out = out.unionByName(metric_records(spark, table, kind, reference, compute(view)))
    return out


def signal_records(spark, table, twin, views, p) -> DataFrame:
    return _records(
        spark, table, twin, views, lambda t: signal_values(t.source, t.unshuffled, t.columns)
    )


def privacy_records(spark, table, twin, views, p) -> DataFrame:
    return _records(spark, table, twin, views, lambda t: privacy_values(t, p))


def advise_parameters(dataset: DatasetSpec, parameters: ParameterSet, table: str | None = None):
    """Parameters with the advised k, ncp and reduction filled in for one table or all."""
    for name in [table] if table else list(dataset.tables):
        spec = dataset.tables[name]
        row = advise(spec.data, row_key_of(spec), name).first()
        parameters = parameters.set(
            name, k=row["k"], ncp=row["ncp"],
            use_categorical_reduction=row["use_categorical_reduction"],
        )
    return parameters
