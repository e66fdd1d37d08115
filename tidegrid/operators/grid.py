"""The dense zone x hour grid and its coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.clock import hour_floor, month_bounds, utc_literal, year_month_label
from tidegrid.schemas import FIRST_ZONE, LAST_ZONE


def hours_between(spark: SparkSession, first: dt.datetime, last: dt.datetime) -> DataFrame:
    """Every whole hour from ``first`` to ``last`` inclusive."""
    span = F.sequence(utc_literal(first), utc_literal(last), F.make_dt_interval(hours=F.lit(1)))
    return spark.range(1).select(F.explode(span).alias("pickup_hour_ts"))


def month_hours(spark: SparkSession, year: int, month: int) -> DataFrame:
    start, end = month_bounds(year, month)
    return hours_between(spark, start, end - dt.timedelta(hours=1))


def zone_range(spark: SparkSession, first: int = FIRST_ZONE, last: int = LAST_ZONE) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("pickup_location_id"))


def zone_hour_grid(zones: DataFrame, hours: DataFrame) -> DataFrame:
    """All pairs, wanted here: the grid is the result. The hour list is calendar-bounded (744 a month)."""
    return zones.crossJoin(F.broadcast(hours))


def hourly_counts(trips: DataFrame, zone: str = "pickup_location_id", ts: str = "pickup_datetime") -> DataFrame:
    """Rides per zone and hour; partial counts are combined before the shuffle."""
    return trips.groupBy(F.col(zone).alias("pickup_location_id"), hour_floor(F.col(ts)).alias("pickup_hour_ts")).agg(
        F.count("*").cast("int").alias("ride_count")
    )


def fill_grid(grid: DataFrame, counts: DataFrame) -> DataFrame:
    """Grid cells without rides count 0."""
    return grid.join(counts, ["pickup_location_id", "pickup_hour_ts"], "left").withColumn(
        "ride_count", F.coalesce(F.col("ride_count"), F.lit(0)).cast("int")
    )


def series_spine(observations: DataFrame) -> DataFrame:
    """Every zone over every hour from the first to the last one observed.

    Hours of a month that was never ingested stay null instead of 0, so row offsets equal time offsets.
    """
    bounds = observations.agg(F.min("pickup_hour_ts").alias("a"), F.max("pickup_hour_ts").alias("b"))
    hours = bounds.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.make_dt_interval(hours=F.lit(1)))).alias("pickup_hour_ts")
    )
    zones = observations.select("pickup_location_id").distinct()
    return zone_hour_grid(zones, hours).join(
        observations.select("pickup_location_id", "pickup_hour_ts", "ride_count"),
        ["pickup_location_id", "pickup_hour_ts"],
        "left",
    )


def coverage(observations: DataFrame, year: Column | None = None, month: Column | None = None) -> DataFrame:
    """Rows per YYYY-MM, in order."""
    year = F.col("target_year") if year is None else year
    month = F.col("target_month") if month is None else month
    return (
        observations.groupBy(year_month_label(year, month).alias("year_month"))
        .agg(F.count("*").alias("observation_count"))
        .orderBy("year_month")
    )


def missing_months(observed: DataFrame) -> DataFrame:
    """Calendar months between the first and last label of a coverage frame that have no rows."""
    month = F.to_date(F.concat("year_month", F.lit("-01")))
    span = observed.agg(F.min(month).alias("a"), F.max(month).alias("b")).select(
        F.explode(F.sequence("a", "b", F.make_ym_interval(F.lit(0), F.lit(1)))).alias("m")
    )
    return span.select(F.date_format("m", "yyyy-MM").alias("year_month")).join(observed, "year_month", "left_anti")


def expected_cells(label: Column, zones: int = LAST_ZONE - FIRST_ZONE + 1) -> Column:
    """Grid size a complete month must have: zones x hours."""
    return F.day(F.last_day(F.to_date(F.concat(label, F.lit("-01"))))) * F.lit(24 * zones)
