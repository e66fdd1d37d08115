"""Derived test views over one data folder (see the fixture notes)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.cost import demand_class, penalty
from tidegrid.operators import quality, series
from tidegrid.operators.tables import Lakehouse
from tidegrid.plans import medallion, training
from tidegrid.session import new_scratch
from tidegrid.sources.trips import read_table, trips_from_events

YEAR, MONTH = 2024, 1
FIRST_ZONE, LAST_ZONE = 2, 20


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def scratch(self, label: str) -> str:
        return new_scratch(self.spark, label)

    def lake(self) -> Lakehouse:
        root = self.scratch("lake")
        return Lakehouse(self.spark, root, prefix=f"lake_{root[-12:]}_")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def trips(self) -> DataFrame:
        return trips_from_events(self.events)

    @cached_property
    def caps(self) -> quality.Caps:
        return quality.outlier_caps(self.trips)

    @cached_property
    def ruled(self) -> DataFrame:
        return quality.with_reasons(self.trips, YEAR, MONTH, self.caps)

    @cached_property
    def clean(self) -> DataFrame:
        """Valid trips under silver names."""
        valid = self.trips.filter(quality.is_valid(YEAR, MONTH, self.caps))
        return valid.select(
            "event_id",
            F.col("tpep_pickup_datetime").alias("pickup_datetime"),
            F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
            F.col("PULocationID").alias("pickup_location_id"),
            F.col("DOLocationID").alias("dropoff_location_id"),
            "trip_distance", "fare_amount", "tip_amount", "payment_type",
            F.col("passenger_count").cast("int").alias("passenger_count"),
        )

    @cached_property
    def hourly(self) -> DataFrame:
        return medallion.utilisation(self.clean)

    @cached_property
    def dense(self) -> DataFrame:
        return medallion.dense_observations(self.clean, YEAR, MONTH, FIRST_ZONE, LAST_ZONE)

    @cached_property
    def area(self) -> DataFrame:
        """The dense grid summed into three areas, so that all classes occur."""
        return self.dense.groupBy(
            (F.col("pickup_location_id") % 3).alias("pickup_location_id"), "pickup_hour_ts"
        ).agg(F.sum("ride_count").cast("int").alias("ride_count"))

    @cached_property
    def feat(self) -> DataFrame:
        return training.feature_frames(self.area)

    @cached_property
    def thresholds(self) -> DataFrame:
        return series.fit_thresholds(self.feat.filter(F.col("split") == "train"), ["pickup_location_id"])

    @cached_property
    def graded(self) -> DataFrame:
        """Features with actual class, persistence baseline and a last-week stand-in model."""
        q25, q75 = F.col("q25"), F.col("q75")
        return series.with_zone_thresholds(self.feat).withColumns(
            {
                "actual_class": demand_class(F.col("ride_count"), q25, q75),
                "baseline_predicted_class": demand_class(F.col("lag_1h"), q25, q75),
                "predicted_class": demand_class(F.col("lag_168h"), q25, q75),
            }
        )

    @cached_property
    def pred(self) -> DataFrame:
        """Settled predictions of the stand-in model."""
        actual, said, base = (F.col(c) for c in ("actual_class", "predicted_class", "baseline_predicted_class"))
        return self.graded.select(
            "pickup_location_id",
            F.col("pickup_hour_ts").alias("prediction_hour_ts"),
            "predicted_class",
            *[F.when(said == c, 0.8).otherwise(0.1).alias(f"prob_class_{c}") for c in (0, 1, 2)],
            "baseline_predicted_class",
            (F.col("pickup_hour_ts") - F.make_dt_interval(hours=F.lit(1))).alias("feature_window_end_ts"),
            F.col("q25").alias("threshold_q25"),
            F.col("q75").alias("threshold_q75"),
            "actual_class",
            F.col("ride_count").alias("actual_ride_count"),
            penalty(actual, said).alias("model_penalty"),
            penalty(actual, base).alias("baseline_penalty"),
        )
