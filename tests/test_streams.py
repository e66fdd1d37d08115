import datetime as dt
import json
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from test_medallion import landing  # noqa: F401 - shared fixture
from tidegrid.functions.clock import utc_literal
from tidegrid.operators.tables import Lakehouse
from tidegrid.registry import QUERIES, streams
from tidegrid.registry.streams import until
from tidegrid.schemas import BRONZE, INGESTION_LEDGER
from tidegrid.session import state_session
from tidegrid.sources.files import present_paths
from tidegrid.streaming import counts, manifests, schedule, watch


def manifest(path, **change):
    body = {
        "dataset": "yellow_taxi", "source_filepath": str(path), "source_filename": path.name, "source_year": 2024,
        "source_month": 1, "file_size_bytes": 1, "discovered_at_utc": "2024-02-01T00:00:00Z",
    }
    return json.dumps({**body, **change}, indent=2)


def test_manifest_lifecycle(spark, lake, landing, tmp_path):  # noqa: F811
    lake.create_all()
    drop, checkpoint = tmp_path / "drop", tmp_path / "checkpoint"
    (drop / "deep").mkdir(parents=True)
    ready = landing / "yellow_tripdata_2024-01.parquet"
    late = landing / "arriving" / "yellow_tripdata_2024-01_late.parquet"
    (drop / "a.manifest.json").write_text(manifest(ready))
    (drop / "deep" / "b.manifest.json").write_text(manifest(late))
    (drop / "broken.manifest.json").write_text('{"dataset": ')
    incomplete = json.loads(manifest(ready))
    del incomplete["source_month"]
    (drop / "c.manifest.json").write_text(json.dumps(incomplete))
    (drop / "notes.json").write_text("not a manifest")

    def drain():
        manifests.ingest_stream(lake, str(drop), str(checkpoint)).awaitTermination()

    drain()
    assert lake.read(BRONZE).count() == 600
    reasons = sorted(r["reject_reason"] for r in lake.read(manifests.REJECTED).collect())
    assert reasons == ["malformed", "missing: source_month"]
    assert [r["source_filename"] for r in manifests.waiting(lake).collect()] == [late.name]
    drain()  # nothing new: handled manifests never fire again
    assert lake.read(BRONZE).count() == 600

    late.parent.mkdir()
    (landing / late.name).rename(late)
    assert manifests.retry_pending(lake).total_rows == 400
    assert manifests.waiting(lake).isEmpty()
    assert manifests.retry_pending(lake) is None

    # same bytes under another name: no new rows; and a replay from a fresh checkpoint adds none either
    (drop / "d.manifest.json").write_text(manifest(landing / "yellow_tripdata_2024-01_copy.parquet"))
    drain()
    manifests.ingest_stream(lake, str(drop), str(tmp_path / "fresh")).awaitTermination()
    assert lake.read(BRONZE).count() == 1000
    assert lake.read(INGESTION_LEDGER).count() == 2


def test_append_mode_withholds_open_windows(spark, small, tmp_path):
    schema = spark.read.parquet(f"{small}/events.parquet").schema
    stream = counts.parquet_stream(spark, small, schema, "events.parquet")
    hourly = counts.hourly_stream_counts(stream, zone="user_id", ts="ts", lateness="1 hour")
    seen = []
    counts.run_available(
        hourly, str(tmp_path / "c"), lambda batch, _: seen.append(batch.agg(F.sum("ride_count")).first()[0]), "append"
    ).awaitTermination()
    total = sum(s for s in seen if s)
    assert 0 < total < 1000


def test_watched_manifest_waits_for_its_file_over_a_restart(spark, landing, tmp_path):  # noqa: F811
    session = state_session(spark)
    lake = Lakehouse(session, str(tmp_path / "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_").create_all()
    drop, checkpoint = tmp_path / "drop", tmp_path / "checkpoint"
    drop.mkdir()
    ready = landing / "yellow_tripdata_2024-01.parquet"
    late = landing / "arriving" / "yellow_tripdata_2024-01_late.parquet"
    (drop / "a.manifest.json").write_text(manifest(ready))
    (drop / "b.manifest.json").write_text(manifest(late))
    (drop / "broken.manifest.json").write_text('{"dataset": ')
    (drop / "never.manifest.json").write_text(manifest(landing / "yellow_tripdata_2024-01_never.parquet", source_month=2))

    def run(give_up=None):
        return watch.watch_stream(lake, str(drop), str(checkpoint), every="1 second", retry=dt.timedelta(seconds=1), give_up=give_up)

    until(run(), lambda s: watch.told(s, watch.READY) >= 1 and watch.told(s, manifests.WAITING) >= 2)
    assert lake.read(BRONZE).count() == 600
    assert [r["reject_reason"] for r in lake.read(manifests.REJECTED).collect()] == ["malformed"]
    assert manifests.waiting(lake).count() == 2
    late.parent.mkdir()
    (landing / late.name).rename(late)
    (drop / "again.manifest.json").write_text(manifest(ready))
    # no new manifest names the late file: the timer kept in the checkpoint finds it; the other is given up
    stream = run(dt.timedelta(seconds=1))
    until(stream, lambda s: watch.told(s, watch.READY) >= 1 and watch.told(s, watch.GIVEN_UP) >= 1)
    assert lake.read(BRONZE).count() == 1000
    assert lake.read(INGESTION_LEDGER).count() == 2
    states = {r["state"]: r["n"] for r in lake.read(manifests.STATE).groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert states == {manifests.HANDLED: 2, watch.GIVEN_UP: 1}


def test_stop_lets_the_batch_under_way_finish(spark, landing, tmp_path, monkeypatch):  # noqa: F811
    """A killed state task can take its executor along, so a stop comes between two batches."""
    session = state_session(spark)
    lake = Lakehouse(session, str(tmp_path / "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_").create_all()
    drop, begun, ended = tmp_path / "drop", [], []
    drop.mkdir()
    (drop / "a.manifest.json").write_text(manifest(landing / "yellow_tripdata_2024-01.parquet"))
    handle = watch.handle_events

    def late(frames):
        import time

        time.sleep(3)
        yield from frames

    def slow(lake, batch, **options):
        begun.append(batch)
        batch.sparkSession.range(1).mapInPandas(late, "id long").collect()
        handle(lake, batch, **options)
        ended.append(batch)

    monkeypatch.setattr(watch, "handle_events", slow)
    stream = watch.watch_stream(lake, str(drop), str(tmp_path / "checkpoint"), every="1 second")
    limit = time.monotonic() + 120
    while not (begun and spark.sparkContext.statusTracker().getActiveJobsIds()) and time.monotonic() < limit:
        time.sleep(0.1)
    stream.stop()
    assert begun and begun == ended
    assert not stream.isActive and stream.exception() is None
    assert lake.read(BRONZE).count() == 600


def test_late_file_is_found_after_a_stop_between_triggers(spark, landing, tmp_path):  # noqa: F811
    session = state_session(spark)
    lake = Lakehouse(session, str(tmp_path / "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_").create_all()
    drop = tmp_path / "drop"
    drop.mkdir()
    late = landing / "arriving" / "yellow_tripdata_2024-01_late.parquet"
    (drop / "b.manifest.json").write_text(manifest(late))

    def run():
        return watch.watch_stream(lake, str(drop), str(tmp_path / "checkpoint"), every="8 seconds", retry=dt.timedelta(seconds=1))

    until(run(), lambda s: watch.told(s, manifests.WAITING) >= 1 and not s.status["isTriggerActive"], 120)
    late.parent.mkdir()
    (landing / late.name).rename(late)
    until(run(), lambda s: watch.told(s, watch.READY) >= 1, 60)
    assert lake.read(BRONZE).count() == 400


def test_watched_query_outlives_its_cache(spark, tmp_path, monkeypatch):
    """A lost executor takes cached rows along; once the files are moved, they can't be listed again."""
    start, folder = dt.datetime(2024, 1, 5), tmp_path / "tables"
    folder.mkdir()
    columns = {
        "event_id": list(range(40)), "ts": [start + dt.timedelta(minutes=i) for i in range(40)], "user_id": list(range(40)),
        "event_type": ["view"] * 40, "value": [5.0 + i for i in range(40)], "props": [f'{{"k": {i % 50}}}' for i in range(40)],
    }
    pq.write_table(pa.table(columns), folder / "events.parquet")
    moved = streams.moved

    def moved_and_lost(v, source, target):
        moved(v, source, target)
        spark.catalog.clearCache()

    monkeypatch.setattr(streams, "moved", moved_and_lost)
    row = QUERIES["i2_watched_manifests"](spark, str(folder)).first().asDict()
    assert row == {"bronze_rows": 40, "waited": 3, "waiting": 0, "ledger_rows": 3}


def test_only_paths_that_are_files_are_present(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    paths = [str(tmp_path / "a"), f"file:{tmp_path}/a", str(tmp_path), str(tmp_path / "b"), "/no/such/folder/c", None]
    found = present_paths(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert sorted(r["path"] for r in found) == sorted(paths[:2])
    assert present_paths(spark.createDataFrame([], "path string")).isEmpty()


def test_schedule_by_slots(spark, tmp_path):
    """Zones without trips, zones that no seed knows, unknown hours of the seed, and trips out of order."""
    session = state_session(spark)
    start = dt.datetime(2024, 1, 8)
    hours = [start - dt.timedelta(hours=k) for k in range(1, 169)]
    seen = [(z, h, i % 7 + z) for z in (1, 2) for i, h in enumerate(hours) if not (z == 2 and i == 100)]
    seed = schedule.seed_windows(session.createDataFrame(seen, "pickup_location_id int, pickup_hour_ts timestamp, ride_count int"), utc_literal("2024-01-07 23:00:00"))
    trips = [(1, start + dt.timedelta(minutes=m)) for m in (200, 10, 70, 75, 130, 5)] + [(3, start + dt.timedelta(minutes=100)), (None, start), (1, None)]
    drop, out = str(tmp_path / "drop"), []
    session.createDataFrame(trips, "pickup_location_id int, pickup_datetime timestamp").repartition(3).write.parquet(drop)
    stream = counts.parquet_stream(session, drop, session.read.parquet(drop).schema)
    features = schedule.next_hour_features(stream, seed, "0 seconds")
    counts.run_available(features, str(tmp_path / "c"), lambda b, _: out.extend(b.collect()), "append").awaitTermination()
    got = {(r["pickup_location_id"], (r["pickup_hour_ts"] - start) // dt.timedelta(hours=1)): r for r in out}
    # the newest trip is at 03:20, so hours 0 to 3 can be predicted; zone 3 begins at 01:40
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3), (3, 2), (3, 3)]
    assert [got[1, h]["lag_1h"] for h in range(4)] == [1.0, 2.0, 2.0, 1.0]
    assert [got[2, h]["lag_1h"] for h in range(4)] == [2.0, 0.0, 0.0, 0.0]
    assert got[1, 0]["rolling_6h_mean"] == sum(i % 7 + 1 for i in range(6)) / 6
    assert got[3, 2]["lag_1h"] == 1.0 and got[3, 3]["lag_1h"] == 0.0 and got[3, 3]["lag_24h"] is None and got[3, 3]["rolling_6h_mean"] is None
    # hour index 100 of zone 2's history is unknown: only features that need it are null
    assert got[2, 0]["lag_168h"] is not None and all(got[2, h]["rolling_24h_std"] is not None for h in range(4))
