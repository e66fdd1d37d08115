"""Streaming queries, drained with the available-now trigger and read back from their sinks."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.clock import utc_literal
from tidegrid.registry.core import query, rounded
from tidegrid.registry.lake import landed
from tidegrid.registry.learning import SCORED, SCORED_COLUMNS, observed_lake, trained
from tidegrid.registry.relational import FEATURE_SQL, HOUR, ZONE
from tidegrid.registry.views import Views
from tidegrid.schemas import BRONZE, FEATURES, INGESTION_LEDGER, PREDICTIONS, SILVER, UTILISATION
from tidegrid.session import checkpointed, state_session
from tidegrid.sources.manifest import to_manifest_json
from tidegrid.sources.trips import trips_from_events
from tidegrid.streaming import counts, manifests, schedule, watch

GLOB = "*.txt"


def drop_manifests(v: Views, folder: str, files) -> None:
    """Write one manifest file per landed file."""
    named = files.select(
        F.lit("yellow_taxi").alias("dataset"), F.col("path").alias("source_filepath"), "source_filename",
        "source_year", "source_month", F.lit(1).cast("long").alias("file_size_bytes"),
        F.current_timestamp().alias("discovered_at_utc"),
    )
    to_manifest_json(named).write.mode("append").option("maxRecordsPerFile", 1).text(folder)


def drain(v: Views, lake, folder: str, checkpoint: str) -> None:
    manifests.ingest_stream(lake, folder, checkpoint, GLOB).awaitTermination()


@query("i1_manifest_stream", "SELECT 'missing: source_year' AS reject_reason, count(*) AS n FROM (SELECT DISTINCT event_type FROM events)")
def _(v: Views):
    """A manifest per event type, each without a year: all are rejected into the side table, once."""
    lake, folder, checkpoint = v.lake().create_all(), v.scratch("manifests"), v.scratch("checkpoint")
    kinds = v.events.select("event_type").distinct()
    files = kinds.select(
        F.concat(F.lit("/nowhere/"), "event_type").alias("path"), F.col("event_type").alias("source_filename"),
        F.lit(None).cast("int").alias("source_year"), F.lit(1).alias("source_month"),
    )
    drop_manifests(v, folder, files)
    for _ in range(2):
        drain(v, lake, folder, checkpoint)
    return lake.read(manifests.REJECTED).groupBy("reject_reason").agg(F.count("*").alias("n"))


@query("i2_pending_manifests", "SELECT count(*) AS bronze_rows, CAST(2 AS BIGINT) AS waited, CAST(0 AS BIGINT) AS waiting FROM events")
def _(v: Views):
    """Manifests arrive before their files: they wait, and a retry ingests them once the files are there."""
    lake, folder, checkpoint = v.lake().create_all(), v.scratch("manifests"), v.scratch("checkpoint")
    files, late = landed(v, 2).cache(), v.scratch("late")
    source = files.first()["path"].rsplit("/", 1)[0]
    # announced under the folder that they will arrive in
    drop_manifests(v, folder, files.withColumn("path", F.concat(F.lit(late + "/"), "source_filename")))
    drain(v, lake, folder, checkpoint)
    waited = manifests.waiting(lake).count()
    moved(v, source, late)
    manifests.retry_pending(lake)
    left = manifests.waiting(lake).agg(F.count("*").alias("waiting"))
    rows = lake.read(BRONZE).agg(F.count("*").alias("bronze_rows"))
    return rows.crossJoin(left).withColumn("waited", F.lit(waited).cast("long"))


def until(stream: StreamingQuery, reached, seconds: float = 300) -> None:
    """Let a stream run until ``reached(stream)`` by its finished batches, then stop it."""
    limit = time.monotonic() + seconds
    try:
        while not reached(stream):
            if not stream.isActive or time.monotonic() > limit:
                raise RuntimeError("the stream ended early or took too long") from stream.exception()
            time.sleep(0.5)
    finally:
        stream.stop()


@query("i2_watched_manifests", "SELECT count(*) AS bronze_rows, CAST(3 AS BIGINT) AS waited, CAST(0 AS BIGINT) AS waiting, CAST(3 AS BIGINT) AS ledger_rows FROM events")
def _(v: Views):
    """Manifests come before their files: each waits with a timer, and a stream restarted from its checkpoint ingests the
    files once they are there, without a new manifest; a repeated manifest does nothing."""
    v = Views(state_session(v.spark), v.folder)
    lake, folder, checkpoint = v.lake().create_all(), v.scratch("manifests"), v.scratch("checkpoint")
    files, late = checkpointed(landed(v, 3)), v.scratch("late")  # read again when the files are elsewhere, so a cache won't do
    source = files.first()["path"].rsplit("/", 1)[0]
    announced = files.withColumn("path", F.concat(F.lit(late + "/"), "source_filename"))
    drop_manifests(v, folder, announced)

    def run() -> StreamingQuery:
        return watch.watch_stream(lake, folder, checkpoint, GLOB, every="1 second", retry=dt.timedelta(seconds=1))

    until(run(), lambda stream: watch.told(stream, manifests.WAITING) >= 3)
    waited = manifests.waiting(lake).count()
    moved(v, source, late)
    until(run(), lambda stream: watch.told(stream, watch.READY) >= 3)
    drop_manifests(v, folder, announced)
    until(run(), lambda stream: any(p.numInputRows for p in stream.recentProgress))
    left = manifests.waiting(lake).agg(F.count("*").alias("waiting"))
    rows = lake.read(BRONZE).agg(F.count("*").alias("bronze_rows")).crossJoin(lake.read(INGESTION_LEDGER).agg(F.count("*").alias("ledger_rows")))
    return rows.crossJoin(left).withColumn("waited", F.lit(waited).cast("long"))


def moved(v: Views, source: str, target: str) -> None:
    """A folder renamed through the file system that Spark uses for it."""
    paths = v.spark._jvm.org.apache.hadoop.fs
    system = paths.Path(source).getFileSystem(v.spark._jsc.hadoopConfiguration())
    system.rename(paths.Path(source), paths.Path(target))


def landed_in(v: Views, folder: str):
    from tidegrid.sources.files import list_files

    return list_files(v.spark, folder, glob="*.parquet").select(
        "path", F.element_at(F.split("path", "/"), -1).alias("source_filename"),
        F.lit(2024).alias("source_year"), F.lit(1).alias("source_month"),
    )


@query(
    "i3_incremental_ingest",
    "SELECT count(*) AS bronze_rows, CAST(3 AS BIGINT) AS files, CAST(3 AS BIGINT) AS ledger_rows FROM events",
)
def _(v: Views):
    """Manifest-driven ingestion; a replay from a fresh checkpoint adds nothing."""
    lake, folder = v.lake().create_all(), v.scratch("manifests")
    drop_manifests(v, folder, landed(v, 3))
    for _ in range(2):
        drain(v, lake, folder, v.scratch("checkpoint"))
    rows = lake.read(BRONZE).agg(
        F.count("*").alias("bronze_rows"), F.count_distinct("source_filename").alias("files")
    )
    return rows.crossJoin(lake.read(INGESTION_LEDGER).agg(F.count("*").alias("ledger_rows")))


@query(
    "i3_stream_to_gold",
    """SELECT CAST(pickup_location_id AS INT) AS pickup_location_id, CAST(sum(trip_count) AS BIGINT) AS trips, count(*) AS hours,
    (SELECT count(*) FROM clean) AS silver_rows FROM hourly GROUP BY 1""",
    after="hourly",
)
def _(v: Views):
    """Manifests drive the whole chain: the stream's batch ingests the month, publishes it and builds both gold tables."""
    lake, folder = v.lake().create_all(), v.scratch("manifests")
    drop_manifests(v, folder, landed(v, 3))
    for _ in range(2):
        manifests.ingest_stream(lake, folder, v.scratch("checkpoint"), GLOB, publish=True).awaitTermination()
    silver = lake.read(SILVER).agg(F.count("*").alias("silver_rows"))
    return lake.read(UTILISATION).groupBy("pickup_location_id").agg(F.sum("trip_count").alias("trips"), F.count("*").alias("hours")).crossJoin(silver)


@query(
    "i3_fresh_checkpoint",
    """SELECT CAST(sum(CASE WHEN event_id % 3 <> 2 THEN 1 ELSE 0 END) AS BIGINT) AS first_rows, count(*) AS bronze_rows,
    CAST(sum(event_id) AS BIGINT) AS id_sum FROM events""",
)
def _(v: Views):
    """Old and new manifests after a checkpoint was lost: batch numbers start again, no row is replaced."""
    lake, folder, seen = v.lake().create_all(), v.scratch("manifests"), []
    trips = v.trips.drop("source_year", "source_month").withColumn("congestion_surcharge", F.col("event_id").cast("double"))
    for part in ("event_id % 3 <> 2", "event_id % 3 = 2"):
        data = v.scratch("part")
        trips.where(part).drop("event_id").coalesce(2).write.parquet(data)
        drop_manifests(v, folder, landed_in(v, data))
        drain(v, lake, folder, v.scratch("checkpoint"))
        seen.append(lake.read(BRONZE).count())
    found = lake.read(BRONZE).agg(F.count("*").alias("bronze_rows"), F.sum("congestion_surcharge").cast("long").alias("id_sum"))
    return found.withColumn("first_rows", F.lit(seen[0]).cast("long"))


@query(
    "i4_hourly_stream_counts",
    "SELECT CAST(user_id % 20 + 1 AS INT) AS pickup_location_id, date_trunc('hour', CASE WHEN k = 97 THEN ts - INTERVAL 31 DAY ELSE ts END) AS pickup_hour_ts, count(*) AS ride_count FROM x GROUP BY ALL",
    after="x",
)
def _(v: Views):
    """Running hourly counts kept in a keyed table by update mode and upsert."""
    lake = v.lake()
    schema = v.spark.read.parquet(f"{v.folder}/events.parquet").schema
    stream = counts.parquet_stream(v.spark, v.folder, schema, "events.parquet")
    trips = trips_from_events(stream).select(F.col("PULocationID").alias(ZONE), F.col("tpep_pickup_datetime").alias("pickup_datetime"))
    hourly = counts.hourly_stream_counts(trips, lateness="60 days")
    counts.publish_counts(lake, hourly, v.scratch("checkpoint")).awaitTermination()
    return lake.read(counts.LIVE_COUNTS).select(ZONE, HOUR, "ride_count")


SEEDED, CUT = "2024-01-10 23:00:00", "2024-01-20 12:00:00"
_PREDICTED = f"""pickup_hour_ts > TIMESTAMP '{SEEDED}'
    AND pickup_hour_ts <= (SELECT date_trunc('hour', max(pickup_datetime) - INTERVAL 3 HOUR) FROM clean)"""


def through_the_hours(v: Views, start) -> None:
    """``start(features, checkpoint)`` over trips in two drops with a restart between them. A fifth of the last two hours of the first
    drop comes late, in the second one. The area counts up to ``SEEDED`` are the history."""
    folder, checkpoint = v.scratch("drops"), v.scratch("checkpoint")
    trips = v.clean.select((F.col(ZONE) % 3).alias(ZONE), "pickup_datetime", "event_id").filter(F.col("pickup_datetime") >= utc_literal("2024-01-11 00:00:00"))
    cut = utc_literal(CUT)
    held_back = (F.col("pickup_datetime") >= cut - F.expr("INTERVAL 2 HOURS")) & (F.col("event_id") % 5 == 0)
    early = (F.col("pickup_datetime") < cut) & ~held_back
    seed = schedule.seed_windows(v.area, utc_literal(SEEDED))
    for drop in (trips.filter(early), trips.filter(~early)):
        drop.drop("event_id").write.mode("append").parquet(folder)
        stream = counts.parquet_stream(v.spark, folder, drop.drop("event_id").schema)
        start(schedule.next_hour_features(stream, seed, "3 hours"), checkpoint).awaitTermination()


@query("i4_next_hour_features", f"SELECT pickup_location_id, pickup_hour_ts, {FEATURE_SQL} FROM lagged WHERE {_PREDICTED}", after="lagged")
def _(v: Views):
    """Features of every area's next hour out of the stream's state, with late trips and a restart."""
    v = Views(state_session(v.spark), v.folder)
    lake = v.lake()
    through_the_hours(v, lambda features, checkpoint: schedule.publish_features(lake, features, checkpoint))
    return rounded(lake.read(schedule.LIVE_FEATURES).select(ZONE, HOUR, *FEATURES))


@query("i5_scored_schedule", SCORED.format(where=_PREDICTED), after="pred")
def _(v: Views):
    """The champion scores each hour as the stream completes the hour before."""
    path, v = trained(v).champion, Views(state_session(v.spark), v.folder)
    lake = observed_lake(v)
    through_the_hours(v, lambda features, checkpoint: schedule.score_schedule(lake, features, path, checkpoint))
    return lake.read(PREDICTIONS).select(*SCORED_COLUMNS)
