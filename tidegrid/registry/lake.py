"""Table operations and dataflows, run on written tables in the scratch location and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import clock
from tidegrid.operators.tables import Lakehouse
from tidegrid.plans import medallion, report, scoring, training
from tidegrid.registry.core import query, r6, rounded, sql_class
from tidegrid.registry.relational import HOURLY_SQL, HOUR, NOW, PENDING_SQL, ZONE, _RAW_SELECT, pending_pred
from tidegrid.registry.views import FIRST_ZONE, LAST_ZONE, MONTH, YEAR, Views
from tidegrid.schemas import (
    BRONZE, COMMIT_LOG, INGESTION_LEDGER, OBSERVATIONS, PREDICTION_COLUMNS, PREDICTIONS, PUBLISH_LEDGER, QUARANTINE, SERVING,
    SETTLEMENT_COLUMNS, SILVER, UTILISATION, TableSpec, ddl,
)
from tidegrid.sources import files as sources
from tidegrid.sources.manifest import derive_manifests, parse_manifests
from tidegrid.sources.trips import conform
from tidegrid.sources.zone_map import row_groups, scan_range

AT = dt.datetime(2024, 2, 1, 3, tzinfo=dt.timezone.utc)
RUN = "run-1"

ORDER_MONTHS = TableSpec(
    "gold.order_months",
    ddl("order_year int, order_month int, o_orderstatus string, orders long, revenue double"),
    partition_by=("order_year", "order_month"),
)
_ORDER_SQL = """SELECT CAST(year(o_orderdate) AS INT) AS order_year, CAST(month(o_orderdate) AS INT) AS order_month, o_orderstatus,
    count(*) AS orders, round(sum(o_totalprice), 2) + 0.0 AS revenue FROM orders {where} GROUP BY ALL"""


def order_months(v: Views) -> DataFrame:
    date = F.col("o_orderdate")
    return (
        v.table("orders")
        .groupBy(F.year(date).alias("order_year"), F.month(date).alias("order_month"), "o_orderstatus")
        .agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("revenue"))
    )


def landed(v: Views, parts: int = 4) -> DataFrame:
    """The trips as landed Parquet files, listed with their source month."""
    folder = v.scratch("landing")
    v.trips.drop("event_id", "source_year", "source_month").repartition(parts).write.parquet(folder)
    return sources.list_files(v.spark, folder, glob="*.parquet").select(
        "path", F.element_at(F.split("path", "/"), -1).alias("source_filename"),
        F.lit(YEAR).alias("source_year"), F.lit(MONTH).alias("source_month"),
    )


def bronze_lake(v: Views) -> Lakehouse:
    """A lake whose bronze table holds the trips of one run, written directly."""
    lake = v.lake()
    for spec in (BRONZE, SILVER, QUARANTINE, INGESTION_LEDGER, PUBLISH_LEDGER, COMMIT_LOG):
        lake.create(spec)
    at = F.lit(AT)
    rows = conform(v.trips, keep=("source_year", "source_month")).withColumns(
        {
            "source_filename": F.lit("trips_2024-01.parquet"), "source_checksum": F.lit("c0ffee"),
            "ingestion_run_id": F.lit(RUN), "ingested_at_utc": at,
        }
    )
    lake.append(BRONZE, rows, balance=False)
    entry = [("trips_2024-01.parquet", "c0ffee", RUN, "SUCCESS", AT)]
    lake.append(INGESTION_LEDGER, v.spark.createDataFrame(entry, INGESTION_LEDGER.schema))
    return lake


def silver_lake(v: Views) -> Lakehouse:
    lake = bronze_lake(v)
    medallion.silver_wap(lake, RUN, "trips_2024-01.parquet", YEAR, MONTH, at=AT)
    return lake


def gold_lake(v: Views) -> Lakehouse:
    lake = silver_lake(v)
    lake.create(UTILISATION)
    lake.create(OBSERVATIONS)
    medallion.gold_utilisation(lake, YEAR, MONTH, AT)
    medallion.gold_observations(lake, YEAR, MONTH, AT, FIRST_ZONE, LAST_ZONE)
    return lake


def prediction_records(v: Views, scored_at: dt.datetime = AT, frame: DataFrame | None = None) -> DataFrame:
    """``pred`` in the full 20-column layout plus the stored month."""
    named = (v.pred if frame is None else frame).withColumns(
        {
            "scored_at_ts": F.lit(scored_at), "model_name": F.lit("last_week"), "model_version": F.lit("v1"),
            "predicted_label": F.lit("n/a"), "mlflow_run_id": F.lit("none"), "penalty_version": F.lit("asymmetric-v1"),
        }
    )
    return scoring.with_month(named).select(*PREDICTIONS.columns)


def prediction_lake(v: Views, frame: DataFrame | None = None) -> Lakehouse:
    lake = v.lake()
    for spec in (PREDICTIONS, SERVING, OBSERVATIONS):
        lake.create(spec)
    lake.append(PREDICTIONS, prediction_records(v, AT, frame))
    return lake


def with_observations(v: Views, lake: Lakehouse) -> Lakehouse:
    """Area counts as the lake's observation table (zone column = area)."""
    rows = v.area.withColumns({"target_year": F.lit(YEAR), "target_month": F.lit(MONTH)})
    lake.replace_slices(OBSERVATIONS, rows)
    return lake


# ---- A: scans, sources, sinks -------------------------------------------------------

DEMO_CSV = ddl("event_time timestamp, user_id bigint, amount double, device string, page_url string")


def demo_events(v: Views) -> DataFrame:
    return v.events.select(
        F.col("ts").alias("event_time"), "user_id", F.col("value").alias("amount"),
        F.col("event_type").alias("device"), F.col("props").alias("page_url"),
    )


@query(
    "a2_csv_round_trip",
    "SELECT ts AS event_time, user_id, value AS amount, event_type AS device, props AS page_url FROM events",
)
def _(v: Views):
    path = v.scratch("csv")
    sources.write_csv(demo_events(v), path)
    return sources.read_csv(v.spark, path, DEMO_CSV)


def partitioned_events(v: Views) -> str:
    path = v.scratch("hive")
    sources.write_day_partitioned(demo_events(v).drop("page_url"), path, "event_time")
    return path


@query(
    "a3_partitioned_scan",
    """SELECT ts AS event_time, user_id, value AS amount, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
    CAST(day(ts) AS INT) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-12 10:15:00' AND ts < TIMESTAMP '2024-01-14 10:30:00'""",
)
def _(v: Views):
    start, end = (clock.utc_literal(t) for t in ("2024-01-12 10:15:00", "2024-01-14 10:30:00"))
    return (
        sources.read_partitioned(v.spark, partitioned_events(v))
        .filter(sources.day_range_predicate("event_time", start, end))
        .select("event_time", "user_id", "amount", "year", "month", "day")
        .orderBy("event_time")
    )


@query(
    "a4_partitioned_write",
    "SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day, count(*) AS n, round(sum(value), 2) + 0.0 AS amount FROM events GROUP BY ALL",
)
def _(v: Views):
    back = sources.read_partitioned(v.spark, partitioned_events(v))
    sums = back.groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return rounded(sums, 2, "amount")


@query("a5_catalog_table_scan", f"SELECT {_RAW_SELECT} FROM trips", after="trips")
def _(v: Views):
    lake = bronze_lake(v)
    return v.spark.table(lake.name(BRONZE)).select(*[f.name for f in BRONZE.schema.fields[:19]])


@query(
    "a6_create_if_absent",
    "SELECT pickup_datetime, pickup_location_id, trip_distance, strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date FROM clean",
    after="clean",
)
def _(v: Views):
    lake = silver_lake(v)
    lake.create(SILVER)  # a second create leaves data and layout alone
    day = F.date_format("pickup_date", "yyyy-MM-dd").alias("pickup_date")
    return lake.read(SILVER).select("pickup_datetime", ZONE, "trip_distance", day)


@query("a7_append", _ORDER_SQL.format(where=""))
def _(v: Views):
    lake = v.lake()
    lake.create(ORDER_MONTHS)
    early = F.col("order_year") < 1995
    for part in (order_months(v).filter(early), order_months(v).filter(~early)):
        lake.append(ORDER_MONTHS, part)
    return rounded(lake.read(ORDER_MONTHS), 2)


@query("a8_staging_table", "SELECT pickup_location_id, count(*) AS n FROM clean GROUP BY 1", after="clean")
def _(v: Views):
    """The candidate is staged, audited, summarised into a table, and dropped."""
    lake = v.lake()
    summary = TableSpec("audit.candidate_summary", ddl("pickup_location_id int, n long"))
    lake.create(summary)
    with lake.staged(v.clean, "candidate") as candidate:
        lake.append(summary, candidate.groupBy(ZONE).agg(F.count("*").alias("n")))
    return lake.read(summary)


@query("a9_slice_replace", _ORDER_SQL.format(where=""))
def _(v: Views):
    """Two years are damaged and then replaced, twice; the other years stay as they were."""
    lake = v.lake()
    lake.create(ORDER_MONTHS)
    lake.replace_slices(ORDER_MONTHS, order_months(v))
    damaged = F.col("order_year").isin(1994, 1996)
    lake.replace_slices(ORDER_MONTHS, order_months(v).filter(damaged).withColumn("orders", F.lit(-1)))
    for _ in range(2):
        lake.replace_slices(ORDER_MONTHS, order_months(v).filter(damaged))
    return rounded(lake.read(ORDER_MONTHS), 2)


_UPSERT_SQL = """SELECT pickup_location_id, prediction_hour_ts,
    CASE WHEN prediction_hour_ts >= TIMESTAMP '2024-01-15' THEN 2 - predicted_class ELSE predicted_class END AS predicted_class,
    CASE WHEN prediction_hour_ts >= TIMESTAMP '2024-01-15' THEN TIMESTAMP '2024-02-01 04:00:00' ELSE TIMESTAMP '2024-02-01 03:00:00' END AS scored_at_ts,
    actual_class, model_penalty FROM pred"""
_UPSERT_COLUMNS = [ZONE, "prediction_hour_ts", "predicted_class", "scored_at_ts", "actual_class", "model_penalty"]


def _rescored(v: Views, hour: int, **changes) -> DataFrame:
    late = F.col("prediction_hour_ts") >= clock.utc_literal("2024-01-15 00:00:00")
    return prediction_records(v, AT.replace(hour=hour), v.pred.filter(late)).withColumns(changes)


@query("a10_keyed_replace", _UPSERT_SQL, after="pred")
def _(v: Views):
    """Half of the keys are scored again, with their actuals."""
    lake = prediction_lake(v)
    scoring.publish_predictions(lake, _rescored(v, 4, predicted_class=2 - F.col("predicted_class")).drop("prediction_month"))
    return lake.read(PREDICTIONS).select(*_UPSERT_COLUMNS)


@query("a11_keyed_upsert", _UPSERT_SQL, after="pred")
def _(v: Views):
    """Every key arrives twice and without actuals: the newest row wins, settled values stay."""
    lake = prediction_lake(v)
    blank = {c: F.lit(None).cast(PREDICTION_COLUMNS[c].dataType) for c in SETTLEMENT_COLUMNS}
    newer = _rescored(v, 4, predicted_class=2 - F.col("predicted_class"), **blank)
    older = _rescored(v, 2, **blank)
    lake.upsert(PREDICTIONS, older.unionByName(newer), F.col("scored_at_ts"), SETTLEMENT_COLUMNS)
    return lake.read(PREDICTIONS).select(*_UPSERT_COLUMNS)


@query(
    "a12_keyed_extract",
    "SELECT pickup_location_id, prediction_hour_ts, predicted_class, prob_class_2 FROM pred WHERE pickup_location_id = 0 AND prediction_hour_ts = TIMESTAMP '2024-01-21 09:00:00'",
    after="pred",
)
def _(v: Views):
    found = scoring.prediction_at(prediction_lake(v).read(PREDICTIONS), 0, "2024-01-21 09:00:00")
    return found.select(ZONE, "prediction_hour_ts", "predicted_class", "prob_class_2")


@query(
    "a13_predicate_purge",
    _ORDER_SQL.format(where="WHERE NOT (year(o_orderdate) = 1993 AND month(o_orderdate) <= 6) AND o_orderstatus <> 'P'"),
)
def _(v: Views):
    """Whole months and single rows are purged; the survivors remain."""
    lake = v.lake()
    lake.create(ORDER_MONTHS)
    lake.append(ORDER_MONTHS, order_months(v))
    lake.purge(ORDER_MONTHS, (F.col("order_year") == 1993) & (F.col("order_month") <= 6))
    lake.purge(ORDER_MONTHS, F.col("o_orderstatus") == "P")
    return rounded(lake.read(ORDER_MONTHS), 2)


@query("a14_file_fingerprints")
def _(v: Views):
    """SHA-256 of every supplied file."""
    hashed = sources.fingerprints(v.spark, v.folder, glob="*.parquet")
    return hashed.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "size_bytes", "file_checksum")


@query("a15_manifest_derivation")
def _(v: Views):
    """Manifests of the supplied files, read as monthly drops by a naming pattern."""
    listed = sources.list_files(v.spark, v.folder, glob="*.parquet")
    monthly = listed.withColumn("path", F.regexp_replace("path", r"/([a-z]+)\.parquet$", "/$1_tripdata_2024-01.parquet"))
    return derive_manifests(monthly).drop("source_filepath", "discovered_at_utc")


@query(
    "a16_file_inventory",
    "SELECT CAST(day(ts) AS INT) AS day, count(*) AS row_count, min(ts) AS min_value, max(ts) AS max_value FROM events GROUP BY 1",
)
def _(v: Views):
    """Per-file facts of the day-partitioned layout, folded per day so that file splits do not show."""
    back = sources.read_partitioned(v.spark, partitioned_events(v))
    return (
        sources.file_inventory(back, "event_time", "day")
        .groupBy("day")
        .agg(F.sum("row_count").alias("row_count"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))
    )


_RANGED = {"l_orderkey": "bigint", "l_quantity": "double", "l_extendedprice": "double", "l_shipdate": "timestamp_ntz"}


@query(
    "a16_row_groups",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"
        if kind != "timestamp_ntz" else
        f"SELECT '{c}', count(*), count(*) - count({c}), strftime(min({c}), '%Y-%m-%d %H:%M:%S'), strftime(max({c}), '%Y-%m-%d %H:%M:%S') FROM lineitem"
        for c, kind in _RANGED.items()
    ),
)
def _(v: Views):
    """Rows, nulls and ranges of the line items out of the footers' row groups, folded per column; no data page is read."""
    files, out = sources.list_files(v.spark, v.folder, glob="lineitem.parquet"), None
    for column, kind in _RANGED.items():
        found = row_groups(files, column, kind).agg(
            F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
            F.min("min_value").cast("string").alias("min_value"), F.max("max_value").cast("string").alias("max_value"),
        ).withColumn("column_name", F.lit(column))
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "f8_zone_map_scan",
    """SELECT ts, user_id, value AS amount FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00'
    AND ts < TIMESTAMP '2024-01-12 18:30:00' ORDER BY ts""",
)
def _(v: Views):
    """The time range out of the files whose footers' ranges meet it."""
    raw, folder = v.spark.read.parquet(f"{v.folder}/events.parquet"), v.scratch("ranged")
    raw.repartitionByRange(12, "ts").sortWithinPartitions("ts").write.parquet(folder)
    kept = v.scratch("zones")
    row_groups(sources.list_files(v.spark, folder, glob="*.parquet"), "ts", "timestamp_ntz").write.parquet(kept)
    low, high = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 06:00:00", "2024-01-12 18:30:00"))
    found = scan_range(v.spark, v.spark.read.parquet(kept), raw.schema, "ts", low, high)
    return found.select("ts", "user_id", F.col("value").alias("amount")).orderBy("ts")


@query("a17_table_layout")
def _(v: Views):
    return sources.table_layout(silver_lake(v).read(SILVER), ["pickup_date"])


@query(
    "a18_commit_history",
    """SELECT 'silver.yellow_taxi_trips' AS table_name, 'publish' AS operation, 'run-1' AS slice, count(*) AS row_count FROM clean
    UNION ALL SELECT 'quarantine.yellow_taxi_trips', 'publish', 'run-1', count(*) FROM flagged WHERE NOT is_valid
    UNION ALL SELECT 'gold.hourly_fleet_utilization', 'replace', '2024-01', count(*) FROM hourly
    UNION ALL SELECT 'gold.hourly_ml_observations', 'replace', '2024-01', count(*) FROM dense""",
    after="dense",
)
def _(v: Views):
    return gold_lake(v).history().select("table_name", "operation", "slice", "row_count")


@query(
    "a20_time_sliced_load",
    """SELECT CASE WHEN ts < TIMESTAMP '2024-01-07' THEN 0 WHEN ts < TIMESTAMP '2024-01-13' THEN 1 WHEN ts < TIMESTAMP '2024-01-19' THEN 2
    WHEN ts < TIMESTAMP '2024-01-25' THEN 3 ELSE 4 END AS slice, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1""",
)
def _(v: Views):
    """Five disjoint half-open slices in one write, partitioned by slice."""
    lake = v.lake()
    sliced = TableSpec("demo.events", ddl("ts timestamp, user_id bigint, value double, slice int"), partition_by=("slice",))
    lake.create(sliced)
    label = F.lit(4)
    for i, bound in reversed(list(enumerate(("2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25")))):
        label = F.when(F.col("ts") < clock.utc_literal(f"{bound} 00:00:00"), i).otherwise(label)
    lake.append(sliced, v.events.withColumn("slice", label))
    return lake.read(sliced).groupBy("slice").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query(
    "a22_local_rows_to_table",
    "SELECT event_type AS source_filename, 'SUCCESS' AS status, count(*) AS n FROM events GROUP BY 1",
)
def _(v: Views):
    """One ledger row per event type built on the driver, appended, and joined back to the events."""
    lake = v.lake()
    lake.create(INGESTION_LEDGER)
    kinds = [r[0] for r in v.events.select("event_type").distinct().collect()]
    rows = [(k, f"sum-{k}", RUN, "SUCCESS", AT) for k in kinds]
    lake.append(INGESTION_LEDGER, v.spark.createDataFrame(rows, INGESTION_LEDGER.schema))
    counted = v.events.groupBy(F.col("event_type").alias("source_filename")).agg(F.count("*").alias("n"))
    return lake.read(INGESTION_LEDGER).join(counted, "source_filename").select("source_filename", "status", "n")


# ---- contracts and formats on tables ------------------------------------------------


@query(
    "b15_idempotency_guard",
    "SELECT 4 AS ledger_rows, count(*) AS bronze_rows, 'done' AS first_status, 'skipped' AS second_status, 'repaired' AS third_status FROM trips",
    after="trips",
)
def _(v: Views):
    """First run ingests, second skips by checksum, third repairs a lost ledger from bronze."""
    lake, files = v.lake().create_all(), landed(v)
    first = medallion.bronze_ingest(lake, files, RUN, AT)
    second = medallion.bronze_ingest(lake, files, "run-2", AT)
    lake.purge(INGESTION_LEDGER, F.lit(True))
    third = medallion.bronze_ingest(lake, files, "run-3", AT)
    ledger = lake.read(INGESTION_LEDGER).filter(F.col("ingestion_run_id") == RUN).agg(
        F.count("*").cast("int").alias("ledger_rows")
    )
    bronze = lake.read(BRONZE).agg(F.count("*").alias("bronze_rows"))
    status = {"first_status": first, "second_status": second, "third_status": third}
    return ledger.crossJoin(bronze).withColumns({k: F.lit(o.status.value) for k, o in status.items()})


@query("f7_in_file_sort", "SELECT CAST(day(ts) AS INT) AS day, CAST(0 AS BIGINT) AS inversions FROM events GROUP BY 1")
def _(v: Views):
    """Rows out of time order inside their file, counted per day in stored row order."""
    back = sources.read_partitioned(v.spark, partitioned_events(v))
    placed = back.select("day", "event_time", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    earlier = F.lag("event_time").over(Window.partitionBy("f").orderBy("i"))
    return placed.withColumn("p", earlier).groupBy("day").agg(F.count_if(F.col("p") > F.col("event_time")).alias("inversions"))


@query(
    "h25_manifest_json",
    """SELECT event_id, CASE WHEN k % 5 = 0 THEN 'malformed' WHEN k % 5 = 1 THEN 'missing: source_month' END AS reject_reason,
    CASE WHEN k % 5 > 0 THEN event_type END AS dataset FROM x""",
    after="x",
)
def _(v: Views):
    """One manifest text per event: some cut off, some without a required key."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    named = v.events.select(
        "event_id", F.col("event_type").alias("dataset"), F.lit("/x").alias("source_filepath"),
        F.lit("x").alias("source_filename"), F.lit(2024).alias("source_year"),
        F.when(k % 5 != 1, F.lit(1)).alias("source_month"), F.lit(1).cast("long").alias("file_size_bytes"),
        F.col("ts").alias("discovered_at_utc"), k.alias("k"),
    )
    whole = F.to_json(F.struct(*PENDING_FIELDS), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"})
    texts = named.select(
        "event_id", F.when(F.col("k") % 5 == 0, F.concat(F.lit("{oops "), whole)).otherwise(whole).alias("value")
    )
    return parse_manifests(texts).select("event_id", "reject_reason", "dataset")


PENDING_FIELDS = [
    "dataset", "source_filepath", "source_filename", "source_year", "source_month", "file_size_bytes",
    "discovered_at_utc",
]


@query("j1_file_bounds_text")
def _(v: Views):
    """Typed bounds of every file of the day-partitioned layout as column -> text maps."""
    back = sources.read_partitioned(v.spark, partitioned_events(v))
    return sources.file_bounds_text(back, ["event_time", "user_id", "amount", "device"])


# ---- L: dataflows -------------------------------------------------------------------


@query("l1_bronze_ingest", f"SELECT {_RAW_SELECT}, source_year, source_month, 'run-1' AS ingestion_run_id FROM trips", after="trips")
def _(v: Views):
    """Landed files ingested once; a replay under another run adds nothing."""
    lake, files = v.lake().create_all(), landed(v)
    medallion.bronze_ingest(lake, files, RUN, AT)
    medallion.bronze_ingest(lake, files, "run-2", AT)
    return lake.read(BRONZE).drop("source_filename", "source_checksum", "ingested_at_utc")


def _land(v: Views, trips: DataFrame, month: int = MONTH) -> DataFrame:
    """Trips landed as one file, listed under a month."""
    folder = v.scratch("landing")
    trips.drop("event_id", "source_year", "source_month").coalesce(1).write.parquet(folder)
    return sources.list_files(v.spark, folder, glob="*.parquet").select(
        "path", F.element_at(F.split("path", "/"), -1).alias("source_filename"), F.lit(YEAR).alias("source_year"), F.lit(month).alias("source_month"),
    )


@query(
    "l1_run_grows",
    "SELECT count(*) AS bronze_rows, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(1 AS BIGINT) AS runs FROM events",
)
def _(v: Views):
    """One run id ingests a file, comes again with another one; a later run repairs the lost ledger."""
    lake = v.lake().create_all()
    trips = v.trips.withColumn("congestion_surcharge", F.col("event_id").cast("double"))
    first = _land(v, trips.where("event_id % 3 <> 2"))
    both = first.unionByName(_land(v, trips.where("event_id % 3 = 2")))
    medallion.bronze_ingest(lake, first, RUN, AT)
    medallion.bronze_ingest(lake, both, RUN, AT)
    lake.purge(INGESTION_LEDGER, F.lit(True))
    medallion.bronze_ingest(lake, both, "run-2", AT)
    return lake.read(BRONZE).agg(
        F.count("*").alias("bronze_rows"), F.sum("congestion_surcharge").cast("long").alias("id_sum"), F.count_distinct("ingestion_run_id").alias("runs")
    )


@query(
    "l1_crash_with_held_and_fresh",
    "SELECT count(*) AS bronze_rows, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(2 AS BIGINT) AS ledger_rows FROM events",
)
def _(v: Views):
    """A run that crashed before its ledger comes again with one file that bronze holds and one it doesn't."""
    lake = v.lake().create_all()
    trips = v.trips.withColumn("congestion_surcharge", F.col("event_id").cast("double"))
    held = _land(v, trips.where("event_id % 3 <> 2"))
    medallion.bronze_ingest(lake, held, RUN, AT)
    lake.purge(INGESTION_LEDGER, F.lit(True))
    medallion.bronze_ingest(lake, held.unionByName(_land(v, trips.where("event_id % 3 = 2"))), RUN, AT)
    rows = lake.read(BRONZE).agg(F.count("*").alias("bronze_rows"), F.sum("congestion_surcharge").cast("long").alias("id_sum"))
    return rows.crossJoin(lake.read(INGESTION_LEDGER).agg(F.count("*").alias("ledger_rows")))


@query(
    "l2_two_month_run",
    """SELECT CAST(1 AS INT) AS source_month, count(*) AS silver_rows FROM clean
    UNION ALL SELECT 2, count(*) FROM clean WHERE pickup_datetime < TIMESTAMP '2024-01-30'""",
    after="clean",
)
def _(v: Views):
    """One run holds January and the same trips 31 days later: the whole chain publishes both months,
    the second without the days that February lacks."""
    lake = v.lake().create_all()
    later = {c: F.col(c) + F.expr("INTERVAL 31 DAYS") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    files = _land(v, v.trips).unionByName(_land(v, v.trips.withColumns(later), 2))
    medallion.run_month(lake, files, RUN, AT)
    return lake.read(SILVER).groupBy("source_month").agg(F.count("*").alias("silver_rows"))


@query(
    "l2_run_grows",
    """SELECT 'silver' AS part, count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS id_sum FROM clean
    UNION ALL SELECT 'quarantine', count(*), CAST(sum(event_id) AS BIGINT) FROM flagged WHERE NOT is_valid
    UNION ALL SELECT 'gold', count(*), CAST(sum(trip_count) AS BIGINT) FROM hourly
    UNION ALL SELECT 'published files', 2, 2""",
    after="hourly",
)
def _(v: Views):
    """A run of one file is published, comes again with a second file of the month, and once more with nothing new."""
    lake = v.lake().create_all()
    # the id travels in a raw column that no rule looks at
    trips = v.trips.withColumns({"congestion_surcharge": F.col("event_id").cast("double"), "tip_amount": F.col("event_id").cast("double")})
    first = _land(v, trips.where("event_id % 3 <> 2"))
    both = first.unionByName(_land(v, trips.where("event_id % 3 = 2")))
    for files in (first, both, both):
        last = medallion.run_month(lake, files, RUN, AT)
    assert last[1].status is medallion.Status.SKIPPED
    parts = (("silver", SILVER, "tip_amount"), ("quarantine", QUARANTINE, "congestion_surcharge"), ("gold", UTILISATION, "trip_count"))
    counts = [lake.read(t).agg(F.lit(p).alias("part"), F.count("*").alias("row_count"), F.sum(c).cast("long").alias("id_sum")) for p, t, c in parts]
    files = lake.read(PUBLISH_LEDGER).agg(F.lit("published files").alias("part"), F.count("*").alias("row_count"), F.count_distinct("file_checksum").alias("id_sum"))
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(files)


@query(
    "l2_silver_publish",
    """SELECT 'silver' AS part, CAST(pickup_location_id AS INT) AS zone, pickup_datetime AS ts, trip_distance FROM clean
    UNION ALL SELECT 'quarantine', PULocationID, tpep_pickup_datetime, trip_distance FROM flagged WHERE NOT is_valid""",
    after="clean",
)
def _(v: Views):
    lake = silver_lake(v)
    good = lake.read(SILVER).select(
        F.lit("silver").alias("part"), F.col(ZONE).alias("zone"), F.col("pickup_datetime").alias("ts"), "trip_distance"
    )
    bad = lake.read(QUARANTINE).select(
        F.lit("quarantine").alias("part"), F.col("PULocationID").alias("zone"),
        F.col("tpep_pickup_datetime").alias("ts"), "trip_distance",
    )
    return good.unionByName(bad)


@query(
    "l2_gate_breach",
    "SELECT count(*) AS total_rows, 'refused' AS status, CAST(0 AS BIGINT) AS published FROM trips",
    after="trips",
)
def _(v: Views):
    """A limit below the real drop rate publishes nothing to either output."""
    lake = bronze_lake(v)
    out = medallion.silver_wap(lake, RUN, "trips_2024-01.parquet", YEAR, MONTH, max_drop=5.0, at=AT)
    both = lake.read(SILVER).select(ZONE).unionByName(lake.read(QUARANTINE).select(F.col("PULocationID").alias(ZONE)))
    return both.agg(F.count("*").alias("published")).select(
        F.lit(out.total_rows).cast("long").alias("total_rows"), F.lit(out.status.value).alias("status"), "published"
    )


@query("l3_gold_utilisation", HOURLY_SQL.replace("SELECT", "SELECT 2024 AS target_year, 1 AS target_month,", 1), after="hourly")
def _(v: Views):
    lake = silver_lake(v)
    lake.create(UTILISATION)
    medallion.gold_utilisation(lake, YEAR, MONTH, AT)
    return rounded(lake.read(UTILISATION), 9, "avg_distance")


@query(
    "l4_gold_observations",
    "SELECT 2024 AS target_year, 1 AS target_month, pickup_location_id, pickup_hour_ts, ride_count FROM dense",
    after="dense",
)
def _(v: Views):
    lake = silver_lake(v)
    lake.create(OBSERVATIONS)
    medallion.gold_observations(lake, YEAR, MONTH, AT, FIRST_ZONE, LAST_ZONE)
    return lake.read(OBSERVATIONS)


@query(
    "l4_all_zones",
    """SELECT 2024 AS target_year, 1 AS target_month, CAST(z.z AS INT) AS pickup_location_id, h.h AS pickup_hour_ts, CAST(coalesce(a.trip_count, 0) AS INT) AS ride_count
    FROM (SELECT unnest(range(2, 264)) AS z) z
    CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h) h
    LEFT JOIN hourly a ON a.pickup_location_id = z.z AND a.pickup_hour_ts = h.h""",
    after="hourly",
)
def _(v: Views):
    """The dense grid at its default bounds, all 262 zones by every hour of the month."""
    lake = silver_lake(v)
    lake.create(OBSERVATIONS)
    medallion.gold_observations(lake, YEAR, MONTH, AT)
    return lake.read(OBSERVATIONS)


@query(
    "l5_training_frames",
    f"SELECT pickup_location_id, pickup_hour_ts, ride_count, split, q25, q75, {sql_class('ride_count')} AS demand_class, lag_1h, lag_168h, "
    f"{r6('rolling_24h_std')} AS rolling_24h_std FROM graded",
    after="graded",
)
def _(v: Views):
    frames, _ = training.training_frames(v.area)
    chosen = frames.select(
        ZONE, HOUR, "ride_count", "split", "q25", "q75", "demand_class", "lag_1h", "lag_168h", "rolling_24h_std"
    )
    return rounded(chosen, 6, "rolling_24h_std")


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Nullable integers leave as doubles, so that a null looks the same in every client."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_SETTLED_BY_NOON = "CASE WHEN prediction_hour_ts <= TIMESTAMP '2024-01-25 12:00:00' THEN CAST({c} AS DOUBLE) END AS {c}"


@query(
    "l8_settlement",
    "SELECT pickup_location_id, prediction_hour_ts, predicted_class, "
    + ", ".join(_SETTLED_BY_NOON.format(c=c) for c in SETTLEMENT_COLUMNS)
    + " FROM pred",
    after="pred",
)
def _(v: Views):
    lake = with_observations(v, prediction_lake(v, pending_pred(v)))
    scoring.settle(lake, NOW)
    rows = lake.read(PREDICTIONS).select(ZONE, "prediction_hour_ts", "predicted_class", *SETTLEMENT_COLUMNS)
    return _as_double(rows, "actual_class", "actual_ride_count")


@query(
    "l9_serving_sync",
    f"""SELECT CAST(pickup_location_id AS BIGINT) AS pickup_location_id, prediction_hour_ts,
    CAST(predicted_class AS BIGINT) AS predicted_class, CAST(actual_class AS DOUBLE) AS actual_class, model_penalty
    FROM {PENDING_SQL} WHERE prediction_hour_ts BETWEEN TIMESTAMP '2024-01-18' AND TIMESTAMP '2024-01-22'""",
    after="pred",
)
def _(v: Views):
    lake = prediction_lake(v, pending_pred(v))
    for _ in range(2):  # a second sync changes nothing
        scoring.sync_serving(lake, dt.datetime(2024, 1, 18), dt.datetime(2024, 1, 22))
    rows = lake.read(SERVING).select(ZONE, "prediction_hour_ts", "predicted_class", "actual_class", "model_penalty")
    return _as_double(rows, "actual_class")


_RECENT = "FROM pred QUALIFY prediction_hour_ts >= max(prediction_hour_ts) OVER (PARTITION BY pickup_location_id) - INTERVAL 10 DAY"


@query(
    "l10_penalty_report",
    f""", recent AS (SELECT * {_RECENT}), totals AS (SELECT pickup_location_id, sum(model_penalty) AS model_cost,
    sum(baseline_penalty) AS baseline_cost FROM recent GROUP BY 1)
    SELECT pickup_location_id, prediction_hour_ts,
    CASE WHEN actual_class > predicted_class THEN model_penalty ELSE 0.0 END AS underprediction_penalty,
    CASE WHEN predicted_class > actual_class THEN -model_penalty ELSE 0.0 END AS overprediction_penalty,
    sum(model_penalty) OVER w AS model_cumulative, sum(baseline_penalty) OVER w AS baseline_cumulative,
    baseline_cost - model_cost AS net_savings,
    round(CASE WHEN baseline_cost > 0 THEN (baseline_cost - model_cost) / baseline_cost * 100 END, 6) + 0.0 AS savings_percent
    FROM recent JOIN totals USING (pickup_location_id)
    WINDOW w AS (PARTITION BY pickup_location_id ORDER BY prediction_hour_ts ROWS UNBOUNDED PRECEDING)""",
    after="pred",
)
def _(v: Views):
    full = report.penalty_report(v.pred, 10)
    return rounded(
        full.select(
            ZONE, "prediction_hour_ts", "underprediction_penalty", "overprediction_penalty", "model_cumulative",
            "baseline_cumulative", "net_savings", "savings_percent",
        ),
        6, "savings_percent",
    )


_CAPTION = "CASE {c} WHEN 0 THEN 'Low Demand' WHEN 1 THEN 'Normal Demand' WHEN 2 THEN 'High Demand' ELSE 'Pending Ground Truth' END"


@query(
    "l10_latest_cards",
    f"""SELECT pickup_location_id, prediction_hour_ts, {_CAPTION.format(c='predicted_class')} AS predicted_state, '80.00%' AS confidence,
    {_CAPTION.format(c='actual_class')} AS actual_state, coalesce(CAST(CAST(model_penalty AS INT) AS VARCHAR) || ' Units', 'Awaiting Settlement') AS model_loss,
    coalesce(CAST(CAST(baseline_penalty AS INT) AS VARCHAR) || ' Units', 'Awaiting Settlement') AS baseline_loss
    FROM {PENDING_SQL} QUALIFY row_number() OVER (PARTITION BY pickup_location_id ORDER BY prediction_hour_ts DESC) = 1""",
    after="pred",
)
def _(v: Views):
    return report.latest_cards(pending_pred(v))


@query(
    "l11_platform_audit",
    """SELECT 'bronze_rows' AS check_name, count(*) AS measured FROM trips UNION ALL SELECT 'silver_rows', count(*) FROM clean
    UNION ALL SELECT 'quarantine_rows', count(*) FROM flagged WHERE NOT is_valid UNION ALL SELECT 'observation_rows', count(*) FROM dense
    UNION ALL SELECT 'leakage_columns', 0""",
    after="dense",
)
def _(v: Views):
    return report.audit_findings(gold_lake(v))


@query(
    "l11_expected_cells",
    "SELECT '2024-01' AS year_month, count(*) AS observation_count, CAST(31 * 24 * 19 AS BIGINT) AS expected_count, CAST(31 * 24 * 19 AS BIGINT) - count(*) AS missing_count FROM dense",
    after="dense",
)
def _(v: Views):
    """Cells of the dense grid found in the lake against those that a full month has."""
    return report.platform_audit(gold_lake(v))["coverage"]


@query(
    "l11_published_runs",
    """SELECT 'silver.yellow_taxi_trips' AS table_name, 'run-1' AS ingestion_run_id, count(*) AS row_count FROM clean
    UNION ALL SELECT 'quarantine.yellow_taxi_trips', 'run-1', count(*) FROM flagged WHERE NOT is_valid""",
    after="clean",
)
def _(v: Views):
    return report.platform_audit(gold_lake(v))["published"]


@query(
    "l11_commit_history",
    """SELECT 'bronze.yellow_taxi_raw' AS table_name, 'append' AS operation, count(*) AS row_count FROM trips
    UNION ALL SELECT 'silver.yellow_taxi_trips', 'publish', count(*) FROM clean
    UNION ALL SELECT 'quarantine.yellow_taxi_trips', 'publish', count(*) FROM flagged WHERE NOT is_valid""",
    after="clean",
)
def _(v: Views):
    """What one ingested and published run leaves in the commit log."""
    lake = v.lake().create_all()
    medallion.bronze_ingest(lake, landed(v), RUN, AT)
    medallion.silver_wap(lake, RUN, "trips_2024-01.parquet", YEAR, MONTH, at=AT)
    return report.platform_audit(lake)["history"].select("table_name", "operation", "row_count")


@query(
    "l12_rebuild_idempotency",
    "SELECT count(*) AS rows_before, count(*) AS rows_after, true AS same_content FROM hourly",
    after="hourly",
)
def _(v: Views):
    lake = gold_lake(v)
    return report.rebuild_is_idempotent(
        lake, UTILISATION, lambda: medallion.gold_utilisation(lake, YEAR, MONTH, AT), [HOUR, ZONE]
    )


@query(
    "l13_reconciliation",
    """SELECT CASE WHEN prediction_hour_ts > TIMESTAMP '2024-01-25' THEN 'only_left'
    WHEN prediction_hour_ts >= TIMESTAMP '2024-01-20' THEN 'different' ELSE 'equal' END AS state, count(*) AS n FROM pred GROUP BY 1""",
    after="pred",
)
def _(v: Views):
    """The serving copy misses the last days and was taken before settlement of the days before."""
    lake = with_observations(v, prediction_lake(v, pending_pred(v)))
    scoring.sync_serving(lake, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 25))
    scoring.settle(lake, dt.datetime(2024, 1, 31, 23))
    return report.reconcile(lake)

