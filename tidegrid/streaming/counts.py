"""Hourly tumbling counts over a stream of trips."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegrid.operators.tables import Lakehouse
from tidegrid.schemas import TableSpec, ddl

LIVE_COUNTS = TableSpec(
    "gold.live_hourly_counts",
    ddl("pickup_location_id int, pickup_hour_ts timestamp, ride_count long, version long, pickup_date date"),
    partition_by=("pickup_date",),
    keys=("pickup_location_id", "pickup_hour_ts"),
)


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    """A file stream; zone-less timestamps become instants, since watermarks need them."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    naive = {n: F.col(n).cast("timestamp") for n, t in raw.dtypes if t == "timestamp_ntz"}
    return raw.withColumns(naive) if naive else raw


def hourly_stream_counts(
    trips: DataFrame, zone: str = "pickup_location_id", ts: str = "pickup_datetime", lateness: str = "2 hours"
) -> DataFrame:
    """Tumbling one-hour counts per zone; state older than the watermark is dropped."""
    return (
        trips.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 hour"), F.col(zone).alias("pickup_location_id"))
        .agg(F.count("*").alias("ride_count"))
        .select("pickup_location_id", F.col("window.start").alias("pickup_hour_ts"), "ride_count")
    )


def publish_counts(lake: Lakehouse, counts: DataFrame, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Keep a keyed table equal to the running totals (update mode plus keyed upsert)."""
    lake.create(LIVE_COUNTS)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"version": F.lit(batch_id), "pickup_date": F.to_date("pickup_hour_ts")})
        lake.upsert(LIVE_COUNTS, rows, F.col("version"))

    return run_available(counts, checkpoint, write, "update", continuous)


def run_available(
    df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str, continuous: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()
