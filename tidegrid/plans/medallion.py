"""Bronze, silver and gold: ingest files once, publish behind a gate, rebuild monthly marts."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.clock import check_year_month, hour_floor, in_month, in_month_days
from tidegrid.operators import grid, quality
from tidegrid.operators.tables import Lakehouse
from tidegrid.schemas import (
    BRONZE, FIRST_ZONE, INGESTION_LEDGER, LAST_ZONE, MAX_DROP_PERCENT, OBSERVATIONS, PUBLISH_LEDGER,
    QUARANTINE, RAW_TRIP, SILVER, UTILISATION, ddl,
)
from tidegrid.sources.files import fingerprints, footers
from tidegrid.sources.trips import conform


class Status(Enum):
    DONE = "done"
    SKIPPED = "skipped"  # published before, nothing to do
    REPAIRED = "repaired"  # data was present, only the ledger entry was missing
    REFUSED = "refused"  # the quality gate stayed shut, nothing was published
    MISSING = "missing"  # no rows can be found for the request


@dataclass(frozen=True)
class Outcome:
    status: Status
    run_id: str
    total_rows: int = 0
    valid_rows: int = 0
    dropped_percent: float = 0.0


def utc(at: dt.datetime | None = None) -> dt.datetime:
    """A zone-aware load time: the given one (naive counts as UTC) or now."""
    if at is None:
        return dt.datetime.now(dt.timezone.utc)
    return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)


def path_key(path: Column) -> Column:
    """Path without scheme and authority, so that listings and file metadata agree."""
    return F.regexp_replace(path, "^[A-Za-z0-9]+:(//[^/]*)?/*", "/")


# ---- bronze -------------------------------------------------------------------------


def unseen_files(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose checksum has no successful ledger entry; equal bytes in one batch count once."""
    done = ledger.filter(F.col("status") == "SUCCESS").select("file_checksum")
    first = incoming.groupBy("file_checksum").agg(
        F.min_by(F.struct(*incoming.columns), F.struct("source_filename", "path_key")).alias("f")
    )
    return first.select("f.*").join(done, "file_checksum", "left_anti")


def unledgered_files(lake: Lakehouse, unseen: DataFrame) -> DataFrame:
    """Checksums that bronze already holds under a run without ledger entry (crash before the ledger)."""
    known = lake.read(INGESTION_LEDGER).select("ingestion_run_id").distinct()
    months = unseen.select("source_year", "source_month").distinct()
    held = (
        # counted by hash per folder first, as a least text over all rows would sort them; the filter keeps this step in the plan
        lake.read(BRONZE).groupBy("source_year", "source_month", "ingestion_run_id", "source_checksum").agg(F.count("*").alias("n")).where("n > 0")
        .join(F.broadcast(months), ["source_year", "source_month"], "left_semi")  # one row per month
        .join(known, "ingestion_run_id", "left_anti")
        .groupBy(F.col("source_checksum").alias("file_checksum"))
        .agg(F.min("ingestion_run_id").alias("held_run_id"))
    )
    return unseen.join(held, "file_checksum", "left")


def bronze_rows(lake: Lakehouse, files: DataFrame, run_id: str, at: dt.datetime) -> DataFrame | None:
    """Conformed rows of all files with lineage; files of equal footer are read by one scan."""
    spark = lake.spark
    by_footer: dict[str, list[str]] = {}
    read = footers(files).collect()  # one short row per file of the batch
    for row in read:
        by_footer.setdefault(row["footer"], []).append(row["path"])
    lineage = files.select(
        "path_key", "source_filename", F.col("file_checksum").alias("source_checksum"), "source_year", "source_month"
    )
    out = None
    for paths in by_footer.values():
        schema = spark.read.parquet(paths[0]).schema
        scan = spark.read.schema(schema).parquet(*paths)
        rows = (
            scan.withColumn("path_key", path_key(F.col("_metadata.file_path")))
            .drop(*[f.name for f in BRONZE.schema if f.name not in RAW_TRIP.names])
            .join(F.broadcast(lineage), "path_key")  # one short row per file of the batch
        )
        rows = conform(rows, keep=("source_filename", "source_checksum", "source_year", "source_month"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return None
    return out.withColumns({"ingestion_run_id": F.lit(run_id), "ingested_at_utc": F.lit(at)})


def content_run_id(checksums: list[str]) -> str:
    """A run id that a replay of the same files repeats and other files never get."""
    return "batch-" + hashlib.sha256("\n".join(sorted(checksums)).encode()).hexdigest()[:24]


def bronze_ingest(lake: Lakehouse, files: DataFrame, run_id: str | None = None, at: dt.datetime | None = None) -> Outcome:
    """Ingest a batch of files (``path, source_filename, source_year, source_month``) exactly once.

    Known checksums are skipped, whatever their run. Bronze is partitioned by file within a run, so a run
    id may come again with more files: only the slices of files being written are replaced. Without
    a run id the files' contents give one. The driver holds one short row per file of the batch, never
    file contents.
    """
    at = utc(at)
    spark = lake.spark
    listing = files.select("path", "source_filename", "source_year", "source_month").distinct().collect()
    if not listing:
        return Outcome(Status.MISSING, run_id or "")
    for row in listing:
        check_year_month(row["source_year"], row["source_month"])
    named = spark.createDataFrame(listing).withColumn("path_key", path_key(F.col("path"))).drop("path")
    hashed = fingerprints(spark, *[r["path"] for r in listing])
    incoming = hashed.withColumn("path_key", path_key(F.col("path"))).join(named, "path_key")
    batch = _local(spark, incoming)
    run_id = run_id or content_run_id([r["file_checksum"] for r in batch.select("file_checksum").collect()])
    unseen = unseen_files(batch, lake.read(INGESTION_LEDGER))
    found = unledgered_files(lake, unseen).collect()
    if not found:
        return Outcome(Status.SKIPPED, run_id)
    held = [r for r in found if r["held_run_id"] is not None]
    fresh = [r for r in found if r["held_run_id"] is None]
    if held:
        entries = [(r["source_filename"], r["file_checksum"], r["held_run_id"], "SUCCESS", at) for r in held]
        lake.append(INGESTION_LEDGER, spark.createDataFrame(entries, INGESTION_LEDGER.schema).coalesce(1))
    if not fresh:
        return Outcome(Status.REPAIRED, run_id)
    rows = bronze_rows(lake, spark.createDataFrame(fresh, FRESH), run_id, at)
    # each input split feeds one partition, so no shuffle is needed before the write
    written = lake.replace_counted(BRONZE, rows, balance=False)
    entries = [(r["source_filename"], r["file_checksum"], run_id, "SUCCESS", at) for r in fresh]
    lake.append(INGESTION_LEDGER, spark.createDataFrame(entries, INGESTION_LEDGER.schema).coalesce(1))
    lake.log(at, (BRONZE, "append", run_id, written))
    return Outcome(Status.DONE, run_id, total_rows=written, valid_rows=written)


FRESH = ddl(
    "file_checksum string, path_key string, path string, size_bytes long, source_filename string, "
    "source_year int, source_month int, held_run_id string"
)


def _local(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """Evaluate a per-file frame once, so that the files are hashed once."""
    return spark.createDataFrame(batch.collect(), batch.schema)


# ---- silver -------------------------------------------------------------------------


def earliest_success(ledger: DataFrame) -> DataFrame:
    """The run that first ingested each file."""
    return (
        ledger.filter(F.col("status") == "SUCCESS")
        .groupBy("source_filename")
        .agg(F.min_by("ingestion_run_id", F.struct("finished_at", "ingestion_run_id")).alias("ingestion_run_id"))
    )


def resolve_runs(requested: DataFrame, bronze_runs: DataFrame, ledger: DataFrame, published: DataFrame) -> DataFrame:
    """Which run serves each request ``(source_filename, requested_run_id[, source_year, source_month])``.

    A run without bronze rows falls back to the earliest successful run of its file; ``state`` is
    ``skip`` when the serving run (its requested month, if requests name months) is published
    already and ``missing`` when none exists.
    """
    month = [c for c in ("source_year", "source_month") if c in requested.columns]
    own = bronze_runs.select(F.col("ingestion_run_id").alias("requested_run_id")).distinct()
    original = earliest_success(ledger).withColumnRenamed("ingestion_run_id", "_original")
    done = published.filter(F.col("status") == "SUCCESS").select("ingestion_run_id", *month).distinct()
    return (
        requested.join(own.withColumn("_own", F.lit(True)), "requested_run_id", "left")
        .join(original, "source_filename", "left")
        .withColumn("ingestion_run_id", F.when(F.col("_own"), F.col("requested_run_id")).otherwise(F.col("_original")))
        .join(done.withColumn("_done", F.lit(True)), ["ingestion_run_id", *month], "left")
        .select(
            "source_filename", "requested_run_id", "ingestion_run_id",
            F.when(F.col("ingestion_run_id").isNull(), "missing")
            .when(F.col("_done"), "skip")
            .otherwise("run")
            .alias("state"),
        )
    )


def silver_rows(raw: DataFrame, at: dt.datetime) -> DataFrame:
    """Renamed and cast silver columns of raw trips that passed the rules."""
    return raw.select(
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        "trip_distance", "fare_amount", "tip_amount", "payment_type",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        "source_filename", "source_checksum", "source_year", "source_month", "ingestion_run_id",
        F.lit(at).alias("published_at_utc"),
        F.to_date("tpep_pickup_datetime").alias("pickup_date"),
    )


def silver_wap(
    lake: Lakehouse,
    run_id: str,
    source_filename: str,
    year: int,
    month: int,
    max_drop: float = MAX_DROP_PERCENT,
    at: dt.datetime | None = None,
    cap_error: float = 0.0,
) -> Outcome:
    """Audit one ingestion run against the rules and publish clean and quarantined rows.

    The audit is an aggregate over the eight rule columns of immutable bronze files, so it is exact
    for what is written afterwards and spares the second copy a staged candidate would cost. Both
    outputs are partitioned by run and written by overwrite: a retry after a crash replaces, never
    duplicates.

    The publish ledger names every file. A run whose slice holds files that the ledger lacks is audited and written again
    as a whole, so a run that came again with more files reaches silver; a refused one leaves what was published
    before, and is looked at again by the next call.
    """
    check_year_month(year, month)
    at = utc(at)
    spark = lake.spark
    request = spark.createDataFrame(
        [(source_filename, run_id, year, month)], "source_filename string, requested_run_id string, source_year int, source_month int"
    )
    in_slice = (F.col("source_year") == year) & (F.col("source_month") == month)
    runs = lake.read(BRONZE).filter(in_slice & (F.col("ingestion_run_id") == run_id)).select("ingestion_run_id").limit(1)
    plan = resolve_runs(request, runs, lake.read(INGESTION_LEDGER), lake.read(PUBLISH_LEDGER)).first()
    if plan["state"] == "missing":
        return Outcome(Status.MISSING, run_id)
    run_id = plan["ingestion_run_id"]
    of_run = in_slice & (F.col("ingestion_run_id") == run_id)
    raw = lake.read(BRONZE).filter(of_run)
    held = raw.select("source_filename", F.col("source_checksum").alias("file_checksum")).distinct()
    published = lake.read(PUBLISH_LEDGER).filter(of_run & (F.col("status") == "SUCCESS"))
    fresh = held.join(published, "file_checksum", "left_anti")
    if plan["state"] == "skip" and fresh.isEmpty():
        return Outcome(Status.SKIPPED, run_id)

    try:
        caps = quality.outlier_caps(raw, cap_error)
    except quality.QualityError:
        return Outcome(Status.MISSING if raw.isEmpty() else Status.REFUSED, run_id)
    verdict = quality.is_valid(year, month, caps)
    audit = quality.drop_rate(raw, verdict).first()
    total, valid, dropped = audit["total_rows"], audit["valid_rows"], audit["dropped_percent"]
    if not quality.gate_open(dropped, max_drop):
        return Outcome(Status.REFUSED, run_id, total, valid, dropped)

    short = hashlib.sha256(run_id.encode()).hexdigest()[:16]
    bad = raw.filter(~verdict).drop("ingested_at_utc")
    lake.replace_slices(QUARANTINE, bad.withColumns({"wap_run_id": F.lit(short), "quarantined_at": F.lit(at)}), False)
    lake.replace_slices(SILVER, silver_rows(raw.filter(verdict), at))
    if plan["state"] == "skip":
        _drop_emptied(lake, of_run, raw.filter(verdict), total == valid)
    # one short row per file of the slice
    lake.append(
        PUBLISH_LEDGER,
        fresh.select(
            F.lit(run_id).alias("ingestion_run_id"), "source_filename", F.lit(year).alias("source_year"), F.lit(month).alias("source_month"),
            F.lit("SUCCESS").alias("status"), F.lit(at).alias("verified_at"), "file_checksum",
        ).coalesce(1),
    )
    lake.log(at, (SILVER, "publish", run_id, valid), (QUARANTINE, "publish", run_id, total - valid))
    return Outcome(Status.DONE, run_id, total, valid, dropped)


def _drop_emptied(lake: Lakehouse, of_run: Column, good: DataFrame, none_bad: bool) -> None:
    """After a slice was published again: its partitions that got no row this time, because the larger slice has
    other caps, are emptied. A month has at most 31 days and one quarantine partition."""
    days = [r["day"] for r in good.select(F.to_date("tpep_pickup_datetime").alias("day")).distinct().collect()]
    emptied = ((SILVER, ~F.col("pickup_date").isin(days) if days else F.lit(True)), (QUARANTINE, F.lit(none_bad)))
    for spec, gone in emptied:
        parts = list(spec.partition_by)
        for row in lake.read(spec).filter(of_run & gone).select(*parts).distinct().collect():
            lake.drop_partition(spec, {p: row[p] for p in parts})


def run_month(lake: Lakehouse, files: DataFrame, run_id: str | None = None, at: dt.datetime | None = None) -> list[Outcome]:
    """The whole chain for a batch of files: bronze, then silver and both gold tables of every month the
    batch names. Months whose files are all published are skipped, a refused month leaves gold as it was."""
    named = files.select("source_filename", "source_year", "source_month").distinct()
    months = named.groupBy("source_year", "source_month").agg(F.min("source_filename").alias("source_filename")).collect()
    bronze = bronze_ingest(lake, files, run_id, at)
    outcomes = [bronze]
    for m in sorted(months):
        year, month = m["source_year"], m["source_month"]
        done = silver_wap(lake, bronze.run_id, m["source_filename"], year, month, at=at)
        outcomes.append(done)
        if done.status is Status.DONE:
            gold_utilisation(lake, year, month, at)
            gold_observations(lake, year, month, at)
    return outcomes


# ---- gold ---------------------------------------------------------------------------


def silver_month(lake: Lakehouse, year: int, month: int) -> DataFrame:
    """Half-open month of silver; the stored date carries the same range so that folders prune."""
    return lake.read(SILVER).filter(
        in_month_days(F.col("pickup_date"), year, month) & in_month(F.col("pickup_datetime"), year, month)
    )


def utilisation(trips: DataFrame) -> DataFrame:
    """Trips and mean distance per hour and zone; partial sums are combined before the shuffle."""
    return trips.groupBy(hour_floor(F.col("pickup_datetime")).alias("pickup_hour_ts"), "pickup_location_id").agg(
        F.count("*").alias("trip_count"), F.avg("trip_distance").alias("avg_distance")
    )


def gold_utilisation(lake: Lakehouse, year: int, month: int, at: dt.datetime | None = None) -> int:
    """Rebuild one month of the sparse hourly mart in a single commit."""
    check_year_month(year, month)
    mart = utilisation(silver_month(lake, year, month))
    rows = lake.replace_slice(UTILISATION, {"target_year": year, "target_month": month}, mart)
    lake.log(utc(at), (UTILISATION, "replace", f"{year}-{month:02d}", rows))
    return rows


def dense_observations(
    trips: DataFrame, year: int, month: int, first_zone: int = FIRST_ZONE, last_zone: int = LAST_ZONE
) -> DataFrame:
    """Ride count of every zone in every hour of the month, zeros included."""
    spark = trips.sparkSession
    cells = grid.zone_hour_grid(grid.zone_range(spark, first_zone, last_zone), grid.month_hours(spark, year, month))
    return grid.fill_grid(cells, grid.hourly_counts(trips))


def gold_observations(
    lake: Lakehouse, year: int, month: int, at: dt.datetime | None = None,
    first_zone: int = FIRST_ZONE, last_zone: int = LAST_ZONE,
) -> int:
    """Rebuild one month of the dense grid; the leakage contract is checked before the write."""
    check_year_month(year, month)
    cells = dense_observations(silver_month(lake, year, month), year, month, first_zone, last_zone)
    rows = lake.replace_slice(
        OBSERVATIONS, {"target_year": year, "target_month": month}, quality.forbid_leakage(cells)
    )
    lake.log(utc(at), (OBSERVATIONS, "replace", f"{year}-{month:02d}", rows))
    return rows
