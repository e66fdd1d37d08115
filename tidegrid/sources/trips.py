"""Trip rows derived from the supplied ``events`` table (there is no trip table in the test data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.clock import add_hours
from tidegrid.schemas import RAW_TRIP


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One supplied table; its zone-less timestamps become UTC instants."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    naive = {f: F.col(f).cast("timestamp") for f, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(naive) if naive else df


def trips_from_events(events: DataFrame) -> DataFrame:
    """Events as raw trips; ``k`` is the integer inside ``props`` and injects the defects 96, 97, 98."""
    k, ts, value = F.col("k"), F.col("ts"), F.col("value")
    pickup = F.when(k == 97, add_hours(ts, -31 * 24)).otherwise(ts)
    dropoff = (
        F.when(k == 98, None)
        .when(k == 97, pickup + F.make_dt_interval(mins=F.lit(10)))
        .otherwise(pickup + F.make_dt_interval(mins=k))
    )
    # exploding a one-element array keeps ``k`` a column: as a plain projection the optimizer would
    # inline the regular expression into every predicate pushed below it
    number = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return events.select("event_id", "ts", "user_id", "value", F.explode(F.array(number)).alias("k")).select(
        (F.col("event_id") % 2 + 1).cast("int").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.when(k != 96, (k % 6).cast("double")).alias("passenger_count"),
        (value / 10).alias("trip_distance"),
        (F.col("user_id") % 20 + 1).cast("int").alias("PULocationID"),
        ((F.col("user_id") + k) % 20 + 1).cast("int").alias("DOLocationID"),
        (k % 4 + 1).cast("int").alias("payment_type"),
        value.alias("fare_amount"),
        (value * 0.2).alias("tip_amount"),
        (value + 2).alias("total_amount"),
        "event_id",
        F.lit(2024).alias("source_year"),
        F.lit(1).alias("source_month"),
    )


def read_trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_from_events(read_table(spark, folder, "events"))


def conform(df: DataFrame, schema=RAW_TRIP, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select, cast and order columns after ``schema``; absent ones become typed nulls, others go."""
    present = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    return df.select(*columns, *keep)


def stamp(df: DataFrame, **literals) -> DataFrame:
    """Add constant lineage columns."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})
