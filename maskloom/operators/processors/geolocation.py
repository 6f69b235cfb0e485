"""Longitudes normalised per reference latitude, skipping stretches without any point."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.validation import col
from maskloom.operators.histogram import bin_edge, bin_index
from maskloom.session import materialize

MAX_CELLS = 1_000_000


@dataclass(frozen=True)
class GeolocationModel:
    """``slices``: one row per non-empty (reference, bin), at most references x bins rows.

    ``present`` lists the references that hold points; its length is bounded by the parameter.
    """

    spec: GeolocationNormalizationProcessor
    low: float
    high: float
    present: tuple[int, ...]
    slices: DataFrame

    def _latitude(self, index: Column) -> Column:
        n = self.spec.n_reference_lat
        return bin_edge(index, F.lit(self.low), F.lit(self.high), n - 1)

    def _nearest(self, latitude: Column) -> Column:
        """Index of the nearest reference with points; ties go to the lower one.

        The grid cell of the latitude gives the only two candidates by table look-up.
        """
        n = self.spec.n_reference_lat
        below, above, last = [], [], None
        for i in range(n):
            last = i if i in self.present else last
            below.append(last)
        last = None
        for i in reversed(range(n)):
            above.append(last)
            last = i if i in self.present else last
        above.reverse()
        if self.low == self.high:
            return F.lit(self.present[0])
        step = (self.high - self.low) / (n - 1)
        cell = F.floor((latitude - F.lit(self.low)) / F.lit(step)).cast("int")
        cell = F.greatest(F.least(cell, F.lit(n - 1)), F.lit(0)) + 1
        under = F.element_at(F.array(*[F.lit(v).cast("int") for v in below]), cell)
        over = F.element_at(F.array(*[F.lit(v).cast("int") for v in above]), cell)
        to_under = F.abs(self._latitude(under) - latitude)
        to_over = F.abs(self._latitude(over) - latitude)
        return (
            F.when(over.isNull(), under)
            .when(under.isNull(), over)
            .when(to_under <= to_over, under)
            .otherwise(over)
        )

    def _ends(self) -> DataFrame:
        """Per reference: longitude range, number of slices and last slice."""
        return self.slices.groupBy("__ref").agg(
            F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"),
            F.max("__slices").alias("__slices"),
            F.max_by("__bin", "__slice").alias("__last_bin"),
        )

    def _convert(self, df: DataFrame, forward: bool) -> DataFrame:
        lat, lon = self.spec.latitude_variable, self.spec.longitude_variable
        bins = self.spec.n_bins
        value = col(lon).cast("double")
        ends = F.broadcast(self._ends().withColumnRenamed("__ref", "__r"))
        located = df.withColumn("__ref", self._nearest(col(lat).cast("double")))
        located = located.join(ends, F.col("__ref") == F.col("__r"), "left").drop("__r")
        cells = self.slices.select(
            F.col("__ref").alias("__r"), F.col("__bin").alias("__b"),
            F.col("__slice").alias("__s"),
        )
        if forward:
            inside = (value >= F.col("__lo")) & (value < F.col("__hi"))
            wanted = bin_index(value, F.col("__lo"), F.col("__hi"), bins)
            located = located.withColumn("__want", F.when(inside, wanted))
            match = (F.col("__ref") == F.col("__r")) & (F.col("__want") == F.col("__b"))
            located = located.join(F.broadcast(cells), match, "left")
            slot = F.coalesce(F.col("__s"), (F.col("__slices") - 1).cast("int"))
            cell = F.coalesce(F.col("__b"), F.col("__last_bin"))
        else:
            n = F.col("__slices").cast("double")
            guess = F.floor(value * n).cast("int")
            slot = F.coalesce(
                *[
                    F.when(
                        (i >= 0) & (i < F.col("__slices"))
                        & (value >= i / n) & (value < i / n + F.lit(1.0) / n), i,
                    )
                    for i in (guess - 1, guess, guess + 1)
                ],
                (F.col("__slices") - 1).cast("int"),
            )
            located = located.withColumn("__want", slot)
            match = (F.col("__ref") == F.col("__r")) & (F.col("__want") == F.col("__s"))
            located = located.join(F.broadcast(cells), match, "left")
            slot, cell = F.col("__want"), F.col("__b")
        located = located.withColumns({"__slot": slot, "__cell": cell})
        low, high = F.col("__lo"), F.col("__hi")
        begin = bin_edge(F.col("__cell"), low, high, bins)
        finish = bin_edge(F.col("__cell") + 1, low, high, bins)
        n = F.col("__slices").cast("double")
        part0 = F.col("__slot") / n
        part1 = F.col("__slot") / n + F.lit(1.0) / n
        if forward:
            share = (value - begin) / (finish - begin)
            result = part0 + share * (part1 - part0)
        else:
            share = (value - part0) / (part1 - part0)
            result = begin + share * (finish - begin)
        return located.withColumn(lon, result).select(*map(col, df.columns))

    def preprocess(self, df: DataFrame) -> DataFrame:
        return self._convert(df, forward=True)

    def postprocess(self, source: DataFrame, dest: DataFrame) -> DataFrame:
        return self._convert(dest, forward=False)


@dataclass(frozen=True)
class GeolocationNormalizationProcessor:
    """Longitude becomes a position in [0, 1] among the inhabited stretches at its latitude."""

    latitude_variable: str
    longitude_variable: str
    n_reference_lat: int
    n_bins: int

    def __post_init__(self) -> None:
        if self.n_reference_lat < 2:
            raise ValueError("Expected n_reference_lat to be at least 2")
        if self.n_reference_lat * self.n_bins > MAX_CELLS:
            raise ValueError(f"Expected at most {MAX_CELLS} (reference, bin) cells")

    def fit(self, df: DataFrame) -> GeolocationModel:
        n = self.n_reference_lat
        lat = col(self.latitude_variable).cast("double")
        lon = col(self.longitude_variable).cast("double")
        row = df.agg(F.min(lat).alias("lo"), F.max(lat).alias("hi")).first()
        low, high = row["lo"], row["hi"]
        if low is None:
            raise ValueError(f"column {self.latitude_variable} holds no value")
        half = 0.5 * ((high - low) / (n - 1))

        points = df.select(lat.alias("__lat"), lon.alias("__lon")).where(
            "__lat is not null and __lon is not null"
        )
        # a point belongs to every reference within half a step, so to one or (on the border) two
        if low == high:
            candidates = F.array(F.lit(0))
        else:
            step = F.lit((high - low) / (n - 1))
            near = F.floor((F.col("__lat") - F.lit(low)) / step).cast("int")
            candidates = F.array(near - 1, near, near + 1, near + 2)
        points = points.withColumn("__ref", F.explode(candidates))
        ref_lat = bin_edge(F.col("__ref"), F.lit(low), F.lit(high), n - 1)
        points = points.where(
            F.col("__ref").between(0, n - 1)
            & (F.col("__lat") >= ref_lat - F.lit(half))
            & (F.col("__lat") <= ref_lat + F.lit(half))
        ).select("__ref", "__lon")
        spans = points.groupBy("__ref").agg(F.min("__lon").alias("lo"), F.max("__lon").alias("hi"))
        flat = F.col("lo") == F.col("hi")
        spans = spans.select(
            F.col("__ref").alias("__r"),
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("__lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("__hi"),
        )
        binned = points.join(F.broadcast(spans), F.col("__ref") == F.col("__r"), "inner").select(
            "__ref", "__lo", "__hi",
            bin_index(F.col("__lon"), F.col("__lo"), F.col("__hi"), self.n_bins).alias("__bin"),
        )
        cells = binned.groupBy("__ref", "__bin").agg(
            F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi")
        )
        # at most n_bins rows per reference
        packed = cells.groupBy("__ref").agg(
            F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"),
            F.array_sort(F.collect_list("__bin")).alias("__bins"),
        )
        slices = packed.select(
            "__ref", "__lo", "__hi", F.size("__bins").alias("__slices"),
            F.posexplode("__bins").alias("__slice", "__bin"),
        )
        slices = materialize(slices)
        present = tuple(sorted(r["__ref"] for r in slices.select("__ref").distinct().collect()))
        return GeolocationModel(self, low, high, present, slices)
