import datetime as dt
import hashlib
import shutil

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidegrid.plans import medallion, scoring
from tidegrid.plans.medallion import Status
from tidegrid.schemas import (
    BRONZE, INGESTION_LEDGER, OBSERVATIONS, PREDICTIONS, PUBLISH_LEDGER, QUARANTINE, RAW_TRIP, SILVER, UTILISATION,
)
from tidegrid.sources.files import fingerprints, list_files
from tidegrid.sources.manifest import derive_manifests
from tidegrid.sources.trips import read_trips

AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def landing(spark, small, tmp_path):
    """Three named monthly files: two differ in columns and types, the third is a byte copy."""
    trips = read_trips(spark, small).drop("event_id", "source_year", "source_month").toPandas()
    folder = tmp_path / "landing"
    folder.mkdir()
    a = trips.iloc[:600].copy()
    b = trips.iloc[600:].copy().assign(airport_fee=1.5, surprise="x")
    b["PULocationID"] = b["PULocationID"].astype("int64")
    a.to_parquet(folder / "yellow_tripdata_2024-01.parquet", coerce_timestamps="us")
    b.to_parquet(folder / "yellow_tripdata_2024-01_late.parquet", coerce_timestamps="us")
    shutil.copy(folder / "yellow_tripdata_2024-01.parquet", folder / "yellow_tripdata_2024-01_copy.parquet")
    return folder


def listing(spark, folder):
    named = derive_manifests(list_files(spark, str(folder), glob="*.parquet"))
    return named.select(F.col("source_filepath").alias("path"), "source_filename", "source_year", "source_month")


def test_fingerprints_equal_hashlib(spark, landing):
    for limit in (10**9, 0):  # whole files in the JVM, then streamed in blocks
        for r in fingerprints(spark, str(landing), glob="*.parquet", whole_limit=limit).collect():
            path = r["path"].removeprefix("file:")
            with open(path, "rb") as f:
                assert hashlib.sha256(f.read()).hexdigest() == r["file_checksum"]


def test_bronze_conforms_and_deduplicates(spark, lake, landing):
    lake.create_all()
    out = medallion.bronze_ingest(lake, listing(spark, landing), "run-1", AT)
    assert (out.status, out.total_rows) == (Status.DONE, 1000)
    bronze = lake.read(BRONZE)
    assert {f.name: f.dataType for f in bronze.schema if f.name in RAW_TRIP.names} == {
        f.name: f.dataType for f in RAW_TRIP
    }
    fees = {r[0]: r[1] for r in bronze.groupBy("airport_fee").count().collect()}
    assert fees == {None: 600, 1.5: 400}
    assert bronze.select("source_filename").distinct().count() == 2
    assert lake.read(INGESTION_LEDGER).count() == 2
    # replay under another run, then under the same run after the ledger was lost
    assert medallion.bronze_ingest(lake, listing(spark, landing), "run-2", AT).status is Status.SKIPPED
    lake.purge(INGESTION_LEDGER, F.lit(True))
    assert medallion.bronze_ingest(lake, listing(spark, landing), "run-3", AT).status is Status.REPAIRED
    assert {r["ingestion_run_id"] for r in lake.read(INGESTION_LEDGER).collect()} == {"run-1"}
    assert lake.read(BRONZE).count() == 1000


def test_silver_gate_fallback_and_replay(spark, lake, landing):
    lake.create_all()
    medallion.bronze_ingest(lake, listing(spark, landing), "run-1", AT)
    name = "yellow_tripdata_2024-01.parquet"
    first_file = lake.read(INGESTION_LEDGER).orderBy("source_filename").first()["source_filename"]
    refused = medallion.silver_wap(lake, "run-1", name, 2024, 1, max_drop=1.0, at=AT)
    assert refused.status is Status.REFUSED
    assert lake.read(SILVER).isEmpty() and lake.read(QUARANTINE).isEmpty()
    # an unknown run falls back to the run that first ingested the file
    done = medallion.silver_wap(lake, "later-run", first_file, 2024, 1, at=AT)
    assert (done.status, done.run_id) == (Status.DONE, "run-1")
    assert (lake.read(SILVER).count(), lake.read(QUARANTINE).count()) == (773, 227)
    assert medallion.silver_wap(lake, "run-1", name, 2024, 1, at=AT).status is Status.SKIPPED
    assert medallion.silver_wap(lake, "later-run", "no such file", 2024, 1, at=AT).status is Status.MISSING
    # a crash before the ledger entry: the retry replaces both outputs instead of adding to them
    lake.purge(PUBLISH_LEDGER, F.lit(True))
    assert medallion.silver_wap(lake, "run-1", name, 2024, 1, at=AT).status is Status.DONE
    assert (lake.read(SILVER).count(), lake.read(QUARANTINE).count()) == (773, 227)


def test_gold_rebuild(spark, lake, landing):
    lake.create_all()
    medallion.bronze_ingest(lake, listing(spark, landing), "run-1", AT)
    medallion.silver_wap(lake, "run-1", "x", 2024, 1, at=AT)
    for _ in range(2):
        assert medallion.gold_utilisation(lake, 2024, 1, AT) == 743
        assert medallion.gold_observations(lake, 2024, 1, AT) == 262 * 744
    assert lake.read(UTILISATION).count() == 743
    assert lake.read(OBSERVATIONS).agg(F.sum("ride_count")).first()[0] == 773
    assert medallion.gold_utilisation(lake, 2024, 2, AT) == 0


def test_rescoring_keeps_settled_values(spark, lake):
    lake.create(PREDICTIONS)
    lake.create(OBSERVATIONS)
    hour = dt.datetime(2024, 1, 5, 10, tzinfo=dt.timezone.utc)

    def record(scored: dt.datetime, predicted: int):
        values = (
            7, hour, scored, "m", "v", predicted, "Normal", 0.1, 0.8, 0.1, 0, "r", hour, 10.0, 20.0, "asymmetric-v1",
            None, None, None, None,
        )
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PREDICTIONS.schema.fields[:20])
        return spark.createDataFrame([values], schema)

    scoring.publish_predictions(lake, record(hour, 1))
    seen = spark.createDataFrame([(7, hour, 30, 2024, 1)], "pickup_location_id int, pickup_hour_ts timestamp, ride_count int, target_year int, target_month int")
    lake.append(OBSERVATIONS, seen)
    scoring.settle(lake, dt.datetime(2024, 1, 5, 9))  # not due yet
    assert lake.read(PREDICTIONS).first()["actual_class"] is None
    scoring.settle(lake, dt.datetime(2024, 1, 5, 10))
    settled = lake.read(PREDICTIONS).first()
    assert (settled["actual_class"], settled["actual_ride_count"], settled["model_penalty"], settled["baseline_penalty"]) == (2, 30, 15.0, 30.0)
    scoring.publish_predictions(lake, record(hour + dt.timedelta(hours=1), 1))
    again = lake.read(PREDICTIONS).collect()
    assert len(again) == 1 and again[0]["actual_class"] == 2 and again[0]["scored_at_ts"].hour == 11


def test_manifest_names(spark, landing):
    got = {r["source_filename"]: (r["dataset"], r["source_year"], r["source_month"]) for r in
           derive_manifests(list_files(spark, str(landing))).collect()}
    assert got["yellow_tripdata_2024-01.parquet"] == ("yellow_taxi", 2024, 1)
    assert isinstance(pd.DataFrame(got), pd.DataFrame) and len(got) == 3


def test_a_grown_run_replaces_its_slice(spark, lake, tmp_path):
    """The second file lowers the cap, so a day that only a capped row kept alive is emptied again."""
    lake.create_all()
    day = lambda d, h: dt.datetime(2024, 1, d, h)

    def land(name, rows):
        frame = spark.createDataFrame(rows, "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count double, trip_distance double, PULocationID int, DOLocationID int, payment_type int, fare_amount double, tip_amount double, total_amount double")
        path = str(tmp_path / name)
        frame.coalesce(1).write.parquet(path)
        from tidegrid.sources.files import list_files

        return list_files(spark, path, glob="*.parquet").selectExpr("path", f"'{name}' AS source_filename", "2024 AS source_year", "1 AS source_month")

    def trip(d, h, total=20.0):
        return (1, day(d, h), day(d, h) + dt.timedelta(minutes=9), 1.0, 2.0, 5, 6, 1, 10.0, 1.0, total)

    first = land("a", [trip(2, h) for h in range(20)] + [trip(9, 3, 500.0)])
    second = first.unionByName(land("b", [trip(3, h % 24, 30.0 + h / 1000) for h in range(2000)]))
    at = dt.datetime(2024, 2, 1)
    assert medallion.run_month(lake, first, "r1", at)[1].status is medallion.Status.DONE
    assert {r[0] for r in lake.read(SILVER).select(F.dayofmonth("pickup_date")).distinct().collect()} == {2, 9}
    grown = medallion.run_month(lake, second, "r1", at)[1]
    assert (grown.status, grown.total_rows) == (medallion.Status.DONE, 2021)
    assert {r[0] for r in lake.read(SILVER).select(F.dayofmonth("pickup_date")).distinct().collect()} == {2, 3}
    assert lake.read(SILVER).count() + lake.read(QUARANTINE).count() == 2021
    assert lake.read(UTILISATION).agg(F.sum("trip_count")).first()[0] == lake.read(SILVER).count()
    assert medallion.run_month(lake, second, "r1", at)[1].status is medallion.Status.SKIPPED
    assert lake.read(PUBLISH_LEDGER).count() == 2


def test_ingest_sorts_no_rows(spark, lake, landing, monkeypatch):
    """Neither the write of bronze nor the look for held files sorts or shuffles the trips, so a task's memory doesn't grow with its file."""
    lake.create_all()
    plans, insert = [], DataFrameWriter.insertInto

    def watched(self, table, overwrite=None):
        if table == lake.name(BRONZE):
            self._df.createOrReplaceTempView("written")
            text = spark.sql(f"EXPLAIN INSERT OVERWRITE TABLE {table} SELECT * FROM written").first()[0]
            plans.append(text)
        return insert(self, table, overwrite)

    monkeypatch.setattr(DataFrameWriter, "insertInto", watched)
    medallion.bronze_ingest(lake, listing(spark, landing), "run-1", AT)
    assert plans and not any(word in plan for plan in plans for word in ("Sort [", "SortMergeJoin", "Exchange hashpartitioning"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    unseen = spark.createDataFrame([(2024, 1, "c")], "source_year int, source_month int, file_checksum string")
    held = medallion.unledgered_files(lake, unseen)._jdf.queryExecution().executedPlan().toString()
    above = held[: held.index("yellow_taxi_raw")]
    assert above.rfind("HashAggregate(") > above.rfind("SortAggregate(")


def test_more_partitions_than_open_writers(spark, lake):
    from tidegrid.operators.tables import OPEN_WRITERS
    from tidegrid.schemas import TableSpec, ddl

    spec = TableSpec("gold.many", ddl("id long, slot int"), ("slot",))
    lake.create(spec)
    n = OPEN_WRITERS * 3
    rows = spark.range(1000).coalesce(1).selectExpr("id", f"cast(id % {n} as int) as slot")
    assert lake.replace_counted(spec, rows, balance=False) == 1000
    back = lake.read(spec)
    assert back.where(f"slot <> id % {n}").isEmpty() and (back.count(), back.select("id").distinct().count()) == (1000, 1000)
