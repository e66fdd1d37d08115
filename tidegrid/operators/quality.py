"""Validity rules, outlier caps, the publish gate, profiles and schema contracts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.clock import epoch_seconds, in_month, minutes_between
from tidegrid.operators.quantile import discrete_quantiles, interpolated_quantiles
from tidegrid.schemas import (
    CAP_PROBABILITY, EXCLUDED_ZONES, LEAKAGE_COLUMNS, MAX_DROP_PERCENT, MAX_PASSENGERS, MIN_PASSENGERS, MIN_TOTAL,
)


class QualityError(ValueError):
    """A contract or gate refused the data."""


@dataclass(frozen=True)
class Caps:
    """Upper outlier limits of one slice."""

    total_amount: float
    trip_distance: float


def outlier_caps(trips: DataFrame, relative_error: float = 0.0) -> Caps:
    """0.999 quantiles of amount and distance; exact by default, one sketch pass when an error is allowed."""
    columns = ["total_amount", "trip_distance"]
    if relative_error > 0:
        found = trips.approxQuantile(columns, [CAP_PROBABILITY], relative_error)
        values = [f[0] if f else None for f in found]
    else:
        exact = discrete_quantiles(trips, {c: [CAP_PROBABILITY] for c in columns})
        values = [exact[c][0] for c in columns]
    if any(v is None for v in values):
        raise QualityError("no values to derive outlier caps from")
    return Caps(*values)


REQUIRED = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
    "total_amount", "trip_distance", "passenger_count",
]


def validity_rules(year: int, month: int, caps: Caps) -> dict[str, Column]:
    """Named rules; a trip is valid when all hold. None of them is ever null."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")

    def holds(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return {
        "complete": reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED]),
        "positive_duration": holds(epoch_seconds(dropoff) > epoch_seconds(pickup)),
        "amount_in_range": holds(F.col("total_amount").between(MIN_TOTAL, caps.total_amount)),
        "distance_in_range": holds((F.col("trip_distance") > 0) & (F.col("trip_distance") <= caps.trip_distance)),
        "known_zone": holds(~F.col("PULocationID").isin(*EXCLUDED_ZONES)),
        "pickup_in_month": holds(in_month(pickup, year, month)),
        "passengers_in_range": holds(F.col("passenger_count").between(MIN_PASSENGERS, MAX_PASSENGERS)),
    }


def is_valid(year: int, month: int, caps: Caps) -> Column:
    return reduce(lambda a, b: a & b, validity_rules(year, month, caps).values())


def with_verdict(trips: DataFrame, year: int, month: int, caps: Caps) -> DataFrame:
    return trips.withColumns({"is_valid": is_valid(year, month, caps)})


def with_reasons(trips: DataFrame, year: int, month: int, caps: Caps) -> DataFrame:
    """One boolean per rule plus the overall verdict."""
    rules = validity_rules(year, month, caps)
    return trips.withColumns({**rules, "is_valid": reduce(lambda a, b: a & b, rules.values())})


def drop_rate(trips: DataFrame, verdict: Column) -> DataFrame:
    """Total, valid and dropped percentage in one aggregate over the rule columns only."""
    return trips.agg(
        F.count("*").alias("total_rows"), F.count_if(verdict).alias("valid_rows")
    ).withColumn(
        "dropped_percent",
        F.coalesce(
            F.try_divide(F.col("total_rows") - F.col("valid_rows"), F.col("total_rows")) * 100, F.lit(0.0)
        ),
    )


def gate_open(dropped_percent: float, limit: float = MAX_DROP_PERCENT) -> bool:
    return dropped_percent <= limit


# ---- profiles -----------------------------------------------------------------------


def defect_counts(trips: DataFrame, year: int, month: int) -> DataFrame:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips.agg(
        F.count_if(~in_month(pickup, year, month)).alias("pickup_out_of_month"),
        F.count_if(F.col("passenger_count") > MAX_PASSENGERS).alias("passengers_above_5"),
        F.count_if(F.col("passenger_count") <= 0).alias("passengers_not_positive"),
        F.count_if(F.col("total_amount") > 100).alias("total_above_100"),
        F.count_if(pickup > dropoff).alias("pickup_after_dropoff"),
    )


def trip_minutes() -> Column:
    return minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles, max as one row; the quartiles are exact and interpolated."""
    quartiles = interpolated_quantiles(df, {column: [0.25, 0.5, 0.75]})[column]
    value = F.col(column)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles, ("p25", "p50", "p75"))],
        F.max(value).cast("double").alias("max"),
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row per column: its non-null count next to the row and column counts of the table."""
    columns = df.columns
    counted = df.agg(F.count("*").alias("row_count"), *[F.count(c).alias(c) for c in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in columns])
    )
    return counted.select("row_count", F.lit(len(columns)).alias("column_count"), pairs.alias("p")).select(
        "p.column_name", "p.non_null", "row_count", "column_count"
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between the extremes; the last one is closed. The extremes are one row."""
    value = F.col(column)
    extremes = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    width = F.col("hi") - F.col("lo")
    place = F.when(width > 0, F.floor((value - F.col("lo")) / F.when(width > 0, width) * bins)).otherwise(0)
    return (
        df.filter(value.isNotNull())
        .select(value)
        .crossJoin(F.broadcast(extremes))
        .select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )


def sigma_bands(df: DataFrame, column: str, widths=(1, 2, 3)) -> DataFrame:
    """Share of rows within k sample standard deviations of the mean, for each k."""
    value = F.col(column)
    moments = df.agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))
    inside = [F.count_if(F.abs(value - F.col("m")) <= F.col("s") * k).alias(f"k{k}") for k in widths]
    counted = df.select(value).crossJoin(F.broadcast(moments)).agg(F.count(value).alias("n"), *inside)
    rows = F.explode(
        F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("inside"), F.col("n")) for k in widths])
    )
    return counted.select(rows.alias("r")).select(
        "r.k", "r.inside", "r.n", F.try_divide(F.col("r.inside") * 100.0, F.col("r.n")).alias("percent")
    )


# ---- contracts ----------------------------------------------------------------------


def forbid_leakage(df: DataFrame, forbidden=LEAKAGE_COLUMNS) -> DataFrame:
    """Refuse a feature table that carries outcome columns; meant to run before the write."""
    leaked = sorted(set(df.columns) & set(forbidden))
    if leaked:
        raise QualityError(f"leakage columns present: {leaked}")
    return df


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Refuse a frame with missing columns, otherwise put them in the given order."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"missing columns: {missing}")
    return df.select(*columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    sample = repeated_keys(df, keys).take(1)
    if sample:
        raise QualityError(f"key is not unique: {sample[0].asDict()}")
    return df


def is_empty(df: DataFrame) -> bool:
    """Probe that stops at the first row found."""
    return df.isEmpty()
