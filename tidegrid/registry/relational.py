"""Projections, joins, aggregates, windows, rankings, set operations and scalar functions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidegrid.functions import clock, cost, text
from tidegrid.operators import evaluation, grid, quality, series
from tidegrid.operators.group_quantile import grouped_quantiles
from tidegrid.operators.quantile import discrete_quantiles, interpolated_quantiles
from tidegrid.operators.tables import bounded_rows, fingerprint
from tidegrid.plans import medallion, report, scoring
from tidegrid.registry.core import query, r6, rounded, sql_class, sql_penalty
from tidegrid.registry.views import MONTH, YEAR, Views
from tidegrid.schemas import FEATURES
from tidegrid.sources.trips import conform, stamp

ZONE, HOUR = "pickup_location_id", "pickup_hour_ts"
NOW = dt.datetime(2024, 1, 25, 12)

# ---- B: projections, filters, contracts ---------------------------------------------

_RAW_SELECT = """VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
    CAST(NULL AS DOUBLE) AS "RatecodeID", CAST(NULL AS VARCHAR) AS store_and_fwd_flag, PULocationID, DOLocationID,
    payment_type, fare_amount, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax, tip_amount,
    CAST(NULL AS DOUBLE) AS tolls_amount, CAST(NULL AS DOUBLE) AS improvement_surcharge, total_amount,
    CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee"""


@query("b1_missing_column_backfill", f"SELECT {_RAW_SELECT}, event_id FROM trips", after="trips")
def _(v: Views):
    return conform(v.trips, keep=("event_id",))


@query(
    "b2_conforming_projection",
    """SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, trip_distance, fare_amount,
    tip_amount, payment_type, passenger_count FROM clean""",
    after="clean",
)
def _(v: Views):
    return v.clean.drop("event_id")


@query(
    "b3_lineage_stamp",
    """SELECT event_id, 'trips_2024-01' AS source_filename, 'run-1' AS ingestion_run_id,
    TIMESTAMP '2024-02-01 03:00:00' AS ingested_at_utc, source_year, source_month FROM trips""",
    after="trips",
)
def _(v: Views):
    at = dt.datetime(2024, 2, 1, 3, tzinfo=dt.timezone.utc)
    lined = stamp(v.trips, source_filename="trips_2024-01", ingestion_run_id="run-1", ingested_at_utc=at)
    return lined.select(
        "event_id", "source_filename", "ingestion_run_id", "ingested_at_utc", "source_year", "source_month"
    )


_RULE_NAMES = (
    "complete, positive_duration, amount_in_range, distance_in_range, known_zone, pickup_in_month, passengers_in_range"
)


@query("b4_validity_predicate", f"SELECT event_id, {_RULE_NAMES}, is_valid FROM flagged", after="flagged")
def _(v: Views):
    return v.ruled.select("event_id", *_RULE_NAMES.split(", "), "is_valid")


@query(
    "b5_complement_routing",
    """SELECT event_id, CASE WHEN is_valid THEN 'silver' ELSE 'quarantine' END AS routed_to, total_amount, trip_distance
    FROM flagged""",
    after="flagged",
)
def _(v: Views):
    valid = quality.is_valid(YEAR, MONTH, v.caps)
    columns = ["event_id", "total_amount", "trip_distance"]
    good = v.trips.filter(valid).select("event_id", F.lit("silver").alias("routed_to"), *columns[1:])
    bad = v.trips.filter(~valid).select("event_id", F.lit("quarantine").alias("routed_to"), *columns[1:])
    return good.unionByName(bad)


@query(
    "b6_month_bounds_filter",
    """SELECT PULocationID, count(*) AS trips, round(sum(total_amount), 2) + 0.0 AS total FROM trips
    WHERE tpep_pickup_datetime >= TIMESTAMP '2023-12-01' AND tpep_pickup_datetime < TIMESTAMP '2024-01-01' GROUP BY 1""",
    after="trips",
)
def _(v: Views):
    month = v.trips.filter(clock.in_month(F.col("tpep_pickup_datetime"), 2023, 12))
    agg = month.groupBy("PULocationID").agg(F.count("*").alias("trips"), F.sum("total_amount").alias("total"))
    return rounded(agg, 2, "total")


@query(
    "b7_parameter_validation",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) + l AS INT) AS m,
    month(o_orderdate) + l BETWEEN 1 AND 12 AND year(o_orderdate) BETWEEN 2000 AND 2100 AS accepted
    FROM orders CROSS JOIN (SELECT unnest([0, 12]) AS l)""",
)
def _(v: Views):
    date = F.col("o_orderdate")
    asked = v.table("orders").select(
        F.year(date).alias("y"), F.explode(F.array(F.month(date), F.month(date) + 12)).alias("m")
    )
    return asked.distinct().withColumn("accepted", clock.year_month_ok(F.col("y"), F.col("m")))


_PRED_FULL = "SELECT * FROM pred"


@query(
    "b8_point_lookup",
    "SELECT * FROM pred WHERE pickup_location_id = 1 AND prediction_hour_ts = TIMESTAMP '2024-01-20 07:00:00'",
    after="pred",
)
def _(v: Views):
    return scoring.prediction_at(v.pred, 1, "2024-01-20 07:42:10")


@query(
    "b9_history_upper_bound",
    "SELECT * FROM dense WHERE pickup_hour_ts <= TIMESTAMP '2024-01-25 12:00:00'",
    after="dense",
)
def _(v: Views):
    return series.history_until(v.dense, clock.utc_literal(NOW)).select(ZONE, HOUR, "ride_count")


def pending_pred(v: Views):
    """``pred`` with the second half of the month not settled yet."""
    late = F.col("prediction_hour_ts") >= clock.utc_literal("2024-01-20 00:00:00")
    blank = {c: F.when(~late, F.col(c)) for c in ("actual_class", "actual_ride_count", "model_penalty", "baseline_penalty")}
    return v.pred.withColumns(blank)


PENDING_SQL = """(SELECT * REPLACE (
    CASE WHEN prediction_hour_ts < TIMESTAMP '2024-01-20' THEN actual_class END AS actual_class,
    CASE WHEN prediction_hour_ts < TIMESTAMP '2024-01-20' THEN actual_ride_count END AS actual_ride_count,
    CASE WHEN prediction_hour_ts < TIMESTAMP '2024-01-20' THEN model_penalty END AS model_penalty,
    CASE WHEN prediction_hour_ts < TIMESTAMP '2024-01-20' THEN baseline_penalty END AS baseline_penalty) FROM pred)"""


@query(
    "b10_pending_filter",
    f"SELECT pickup_location_id, prediction_hour_ts, predicted_class FROM {PENDING_SQL} "
    "WHERE actual_class IS NULL AND prediction_hour_ts <= TIMESTAMP '2024-01-25 12:00:00'",
    after="pred",
)
def _(v: Views):
    due = evaluation.pending_rows(pending_pred(v), clock.utc_literal(NOW))
    return due.select(ZONE, "prediction_hour_ts", "predicted_class")


@query(
    "b11_lookback_window",
    """SELECT user_id, ts, value FROM events QUALIFY ts >= max(ts) OVER (PARTITION BY user_id) - INTERVAL 7 DAY""",
)
def _(v: Views):
    return series.within_lookback(v.events.select("user_id", "ts", "value"), 7, "user_id", "ts")


@query(
    "b12_emptiness_probe",
    """SELECT 'valued' AS probe, count(*) = 0 AS empty FROM events WHERE value IS NOT NULL
    UNION ALL SELECT 'valueless', count(*) = 0 FROM events WHERE value IS NULL""",
)
def _(v: Views):
    value = F.col("value")
    probes = [("valued", quality.is_empty(v.events.filter(value.isNotNull()))),
              ("valueless", quality.is_empty(v.events.filter(value.isNull())))]
    return v.spark.createDataFrame(probes, "probe string, empty boolean")


@query(
    "b13_null_row_drop",
    "SELECT event_id, passenger_count, tpep_dropoff_datetime FROM trips WHERE passenger_count IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL",
    after="trips",
)
def _(v: Views):
    kept = ["passenger_count", "tpep_dropoff_datetime"]
    return v.trips.select("event_id", *kept).na.drop(subset=kept)


@query(
    "b14_defect_profile",
    """SELECT count(*) FILTER (NOT (tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01')) AS pickup_out_of_month,
    count(*) FILTER (passenger_count > 5) AS passengers_above_5, count(*) FILTER (passenger_count <= 0) AS passengers_not_positive,
    count(*) FILTER (total_amount > 100) AS total_above_100,
    count(*) FILTER (tpep_pickup_datetime > tpep_dropoff_datetime) AS pickup_after_dropoff FROM trips""",
    after="trips",
)
def _(v: Views):
    return quality.defect_counts(v.trips, YEAR, MONTH)


@query(
    "b16_leakage_contract",
    "SELECT pickup_location_id, count(*) AS n, CAST(sum(ride_count) AS BIGINT) AS rides FROM dense GROUP BY 1",
    after="dense",
)
def _(v: Views):
    checked = quality.forbid_leakage(v.dense)
    return checked.groupBy(ZONE).agg(F.count("*").alias("n"), F.sum("ride_count").alias("rides"))


@query(
    "b17_required_columns",
    "SELECT pickup_location_id, prediction_hour_ts, predicted_class, actual_class, model_penalty FROM pred",
    after="pred",
)
def _(v: Views):
    wanted = [ZONE, "prediction_hour_ts", "predicted_class", "actual_class", "model_penalty"]
    return quality.require_columns(v.pred, wanted)


@query(
    "b18_unique_key_contract",
    "SELECT PULocationID, tpep_pickup_datetime, count(*) AS n FROM (SELECT PULocationID, date_trunc('hour', tpep_pickup_datetime) AS tpep_pickup_datetime FROM trips) GROUP BY 1, 2 HAVING count(*) > 1",
    after="trips",
)
def _(v: Views):
    keyed = v.trips.withColumn("tpep_pickup_datetime", clock.hour_floor(F.col("tpep_pickup_datetime")))
    return quality.repeated_keys(keyed, ["PULocationID", "tpep_pickup_datetime"])


# ---- C: joins -----------------------------------------------------------------------


@query(
    "c1_zone_hour_grid",
    "SELECT pickup_location_id, pickup_hour_ts FROM (SELECT DISTINCT pickup_location_id FROM clean) CROSS JOIN (SELECT DISTINCT pickup_hour_ts FROM dense)",
    after="dense",
)
def _(v: Views):
    zones = v.clean.select(ZONE).distinct()
    return grid.zone_hour_grid(zones, grid.month_hours(v.spark, YEAR, MONTH))


@query("c2_dense_grid", "SELECT pickup_location_id, pickup_hour_ts, ride_count FROM dense", after="dense")
def _(v: Views):
    return v.dense


_SETTLED_SQL = f"""SELECT pickup_location_id, prediction_hour_ts, predicted_class, actual_class, actual_ride_count,
    model_penalty, baseline_penalty FROM pred
    WHERE prediction_hour_ts >= TIMESTAMP '2024-01-20' AND prediction_hour_ts <= TIMESTAMP '2024-01-25 12:00:00'"""


@query("c3_settlement_join", _SETTLED_SQL, after="pred")
def _(v: Views):
    due = evaluation.pending_rows(pending_pred(v), clock.utc_literal(NOW))
    return evaluation.settle_rows(due, v.area).select(
        ZONE, "prediction_hour_ts", "predicted_class", "actual_class", "actual_ride_count", "model_penalty",
        "baseline_penalty",
    )


@query(
    "c4_lineage_fallback",
    """SELECT event_type AS source_filename, event_type || '-retry' AS requested_run_id,
    'run-' || CAST(arg_min(event_id, (ts, event_id)) AS VARCHAR) AS ingestion_run_id,
    CASE WHEN event_type = 'click' THEN 'skip' ELSE 'run' END AS state FROM events GROUP BY event_type""",
)
def _(v: Views):
    # every event plays one ledger entry of the file named by its type
    ledger = v.events.select(
        F.col("event_type").alias("source_filename"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("ingestion_run_id"),
        F.lit("SUCCESS").alias("status"), F.col("ts").alias("finished_at"),
    )
    requested = v.events.select(
        F.col("event_type").alias("source_filename"), F.concat("event_type", F.lit("-retry")).alias("requested_run_id")
    ).distinct()
    published = medallion.earliest_success(ledger.filter(F.col("source_filename") == "click")).select(
        "ingestion_run_id", F.lit("SUCCESS").alias("status")
    )
    return medallion.resolve_runs(requested, ledger.limit(0), ledger, published)


@query(
    "c5_point_in_time_lags",
    """SELECT pickup_location_id,
    CAST(max(CASE WHEN pickup_hour_ts = TIMESTAMP '2024-01-25 12:00:00' THEN ride_count END) AS DOUBLE) AS lag_1h,
    CAST(max(CASE WHEN pickup_hour_ts = TIMESTAMP '2024-01-25 11:00:00' THEN ride_count END) AS DOUBLE) AS lag_2h,
    CAST(max(CASE WHEN pickup_hour_ts = TIMESTAMP '2024-01-24 13:00:00' THEN ride_count END) AS DOUBLE) AS lag_24h,
    CAST(max(CASE WHEN pickup_hour_ts = TIMESTAMP '2024-01-18 13:00:00' THEN ride_count END) AS DOUBLE) AS lag_168h,
    count(*) = 168 AS history_complete
    FROM dense WHERE pickup_hour_ts BETWEEN TIMESTAMP '2024-01-18 13:00:00' AND TIMESTAMP '2024-01-25 12:00:00' GROUP BY 1""",
    after="dense",
)
def _(v: Views):
    now = series.features_at(v.dense, clock.utc_literal(NOW))
    return now.select(ZONE, "lag_1h", "lag_2h", "lag_24h", "lag_168h", "history_complete")


@query(
    "c6_ingested_file_antijoin",
    """SELECT min(event_id) AS event_id, sha256(props) AS file_checksum FROM events
    WHERE sha256(props) NOT IN (SELECT sha256(props) FROM events WHERE event_type = 'purchase') GROUP BY sha256(props)""",
)
def _(v: Views):
    # props bytes play file contents; contents already seen on a purchase count as ingested
    hashed = v.events.withColumn("file_checksum", F.sha2("props", 256))
    ledger = hashed.filter(F.col("event_type") == "purchase").select("file_checksum", F.lit("SUCCESS").alias("status"))
    incoming = hashed.select(
        "file_checksum", "event_id",
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("source_filename"), F.lit("").alias("path_key"),
    )
    return medallion.unseen_files(incoming, ledger).select("event_id", "file_checksum")


@query(
    "c7_parameter_broadcast",
    f"SELECT pickup_location_id, pickup_hour_ts, ride_count, q25, q75, {sql_class('ride_count')} AS demand_class "
    "FROM feat CROSS JOIN (SELECT quantile_cont(ride_count, 0.25) AS q25, quantile_cont(ride_count, 0.75) AS q75 FROM feat WHERE split = 'train')",
    after="feat",
)
def _(v: Views):
    one_row = series.fit_thresholds(v.feat.filter(F.col("split") == "train"))
    graded = series.with_demand_class(series.with_thresholds(v.feat, one_row))
    return graded.select(ZONE, HOUR, "ride_count", "q25", "q75", "demand_class")


# ---- D: aggregations ----------------------------------------------------------------

HOURLY_SQL = f"SELECT pickup_hour_ts, pickup_location_id, trip_count, {r6('avg_distance', 9)} AS avg_distance FROM hourly"


@query("d1_hourly_mart", HOURLY_SQL, after="hourly")
def hourly_mart(v: Views):
    return rounded(v.hourly, 9, "avg_distance")


@query(
    "d2_hourly_ride_count",
    "SELECT pickup_location_id, pickup_hour_ts, CAST(trip_count AS INT) AS ride_count FROM hourly",
    after="hourly",
)
def _(v: Views):
    return grid.hourly_counts(v.clean)


@query(
    "d3_coverage_report",
    """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS observation_count,
    CAST(day(last_day(any_value(o_orderdate))) * 24 * 262 AS INT) AS expected_cells FROM orders GROUP BY 1""",
)
def _(v: Views):
    date = F.col("o_orderdate")
    return grid.coverage(v.table("orders"), F.year(date), F.month(date)).withColumn(
        "expected_cells", grid.expected_cells(F.col("year_month"))
    )


@query(
    "d3_missing_months",
    """WITH m AS (SELECT DISTINCT date_trunc('month', l_shipdate) AS m FROM lineitem WHERE month(l_shipdate) <> 7)
    SELECT strftime(s.m, '%Y-%m') AS year_month FROM (SELECT unnest(generate_series((SELECT min(m) FROM m), (SELECT max(m) FROM m), INTERVAL 1 MONTH)) AS m) s
    WHERE s.m NOT IN (SELECT m FROM m)""",
)
def _(v: Views):
    date = F.col("l_shipdate")
    without_july = v.table("lineitem").filter(F.month(date) != 7)
    return grid.missing_months(grid.coverage(without_july, F.year(date), F.month(date)))


@query(
    "d4_zone_totals",
    "SELECT pickup_location_id, CAST(sum(ride_count) AS BIGINT) AS total_rides FROM dense GROUP BY 1",
    after="dense",
)
def _(v: Views):
    return series.zone_totals(v.dense)


@query(
    "d5_month_bounds",
    """SELECT CAST(min(year(o_orderdate)) AS INT) AS min_year, CAST(max(year(o_orderdate)) AS INT) AS max_year,
    CAST(min(month(o_orderdate)) AS INT) AS min_month, CAST(max(month(o_orderdate)) AS INT) AS max_month,
    strftime(min(o_orderdate), '%Y-%m') AS first_label, strftime(max(o_orderdate), '%Y-%m') AS last_label FROM orders""",
)
def _(v: Views):
    date = F.col("o_orderdate")
    year, month = F.year(date), F.month(date)
    label = clock.year_month_label(year, month)
    return v.table("orders").agg(
        F.min(year).alias("min_year"), F.max(year).alias("max_year"),
        F.min(month).alias("min_month"), F.max(month).alias("max_month"),
        F.min(label).alias("first_label"), F.max(label).alias("last_label"),
    )


@query("d6_distinct_months", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def _(v: Views):
    date = F.col("o_orderdate")
    return v.table("orders").select(clock.year_month_label(F.year(date), F.month(date)).alias("year_month")).distinct()


@query(
    "d7_lineage_counts",
    """SELECT event_type AS source_filename, 2024 AS source_year, CAST(month(ts) AS INT) AS source_month,
    'run-' || dayname(ts) AS ingestion_run_id, date_trunc('day', ts) AS ingested_at_utc, count(*) AS record_count
    FROM events GROUP BY ALL""",
)
def _(v: Views):
    ts = F.col("ts")
    bronze = v.events.select(
        F.col("event_type").alias("source_filename"), F.lit(2024).alias("source_year"),
        F.month(ts).alias("source_month"),
        F.concat(F.lit("run-"), F.date_format(ts, "EEEE")).alias("ingestion_run_id"),
        F.date_trunc("day", ts).alias("ingested_at_utc"),
    )
    return report.lineage_counts(bronze)


_PUBLISHED_SQL = """SELECT 'silver.yellow_taxi_trips' AS table_name, 'run-' || PULocationID AS ingestion_run_id, count(*) AS row_count
    FROM flagged WHERE is_valid GROUP BY ALL
    UNION ALL SELECT 'quarantine.yellow_taxi_trips', 'run-' || PULocationID, count(*) FROM flagged WHERE NOT is_valid GROUP BY ALL"""


def _published(v: Views):
    valid = quality.is_valid(YEAR, MONTH, v.caps)
    runs = v.trips.withColumn("ingestion_run_id", F.concat(F.lit("run-"), F.col("PULocationID").cast("string")))
    return report.published_counts(runs.filter(valid), runs.filter(~valid))


@query("d8_published_vs_quarantined", _PUBLISHED_SQL, after="flagged")
def _(v: Views):
    return _published(v)


_PROFILE_SQL = """SELECT 2024 AS target_year, 1 AS target_month, CAST(hour(pickup_hour_ts) AS INT) AS hour_of_day,
    CAST(sum(trip_count) AS BIGINT) AS total_trips, round(avg(avg_distance), 9) + 0.0 AS monthly_avg_distance,
    round(sum(avg_distance * trip_count) / sum(trip_count), 9) + 0.0 AS weighted_avg_distance FROM hourly GROUP BY 3"""


def _profile(v: Views):
    return report.hour_profile(v.hourly.withColumns({"target_year": F.lit(YEAR), "target_month": F.lit(MONTH)}))


@query("d9_hour_of_day_profile", _PROFILE_SQL, after="hourly")
def _(v: Views):
    return rounded(_profile(v), 9)


@query(
    "d10_monthly_totals",
    "SELECT '2024-01' AS time_period, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM hourly",
    after="hourly",
)
def _(v: Views):
    return report.monthly_totals(_profile(v))


@query("d11_outlier_caps", "SELECT cap_total AS total_amount, cap_distance AS trip_distance FROM caps", after="caps")
def _(v: Views):
    caps = v.caps
    return v.spark.createDataFrame([(caps.total_amount, caps.trip_distance)], "total_amount double, trip_distance double")


@query(
    "d11_exact_quantiles_at_volume",
    """SELECT quantile_disc(l_extendedprice, 0.5) AS price_p50, quantile_disc(l_extendedprice, 0.999) AS price_p999,
    CAST(quantile_disc(l_quantity, 0.25) AS DOUBLE) AS quantity_p25 FROM lineitem""",
)
def _(v: Views):
    q = discrete_quantiles(v.table("lineitem"), {"l_extendedprice": [0.5, 0.999], "l_quantity": [0.25]})
    row = (*q["l_extendedprice"], *q["l_quantity"])
    return v.spark.createDataFrame([row], "price_p50 double, price_p999 double, quantity_p25 double")


@query(
    "d12_grouped_quantiles_at_volume",
    """SELECT l_returnflag, l_linenumber, count(*) AS n, round(quantile_cont(l_extendedprice::DOUBLE, 0.25), 6) + 0.0 AS q25,
    round(quantile_cont(l_extendedprice::DOUBLE, 0.75), 6) + 0.0 AS q75, round(quantile_cont(l_extendedprice::DOUBLE, 0.999), 6) + 0.0 AS q999 FROM lineitem GROUP BY 1, 2""",
)
def _(v: Views):
    """Exact quartiles and far quantiles of all groups of the largest table in common passes."""
    found = grouped_quantiles(v.table("lineitem"), ["l_returnflag", "l_linenumber"], "l_extendedprice", [0.25, 0.75, 0.999])
    names = ["q25", "q75", "q999"]
    return rounded(found.select("l_returnflag", "l_linenumber", "n", *(F.col("quantiles")[i].alias(q) for i, q in enumerate(names))), 6, *names)


@query("d12_class_thresholds", "SELECT pickup_location_id, q25, q75 FROM thr", after="thr")
def _(v: Views):
    return v.thresholds


@query(
    "d13_drop_rate_gate",
    """SELECT count(*) AS total_rows, count(*) FILTER (is_valid) AS valid_rows,
    round(100.0 * count(*) FILTER (NOT is_valid) / count(*), 6) + 0.0 AS dropped_percent,
    100.0 * count(*) FILTER (NOT is_valid) / count(*) <= 35.0 AS gate_open FROM flagged""",
    after="flagged",
)
def _(v: Views):
    rate = quality.drop_rate(v.trips, quality.is_valid(YEAR, MONTH, v.caps))
    return rounded(rate.withColumn("gate_open", F.col("dropped_percent") <= 35.0), 6, "dropped_percent")


_MINUTES_SQL = "epoch_us(tpep_dropoff_datetime - tpep_pickup_datetime) / 6e7"


def _durations(v: Views):
    return v.trips.select(quality.trip_minutes().alias("minutes"))


@query(
    "d14_column_profile",
    f"""SELECT count(m) AS count, {r6('avg(m)')} AS mean, {r6('stddev_samp(m)')} AS std, min(m) AS min,
    quantile_cont(m, 0.25) AS p25, quantile_cont(m, 0.5) AS p50, quantile_cont(m, 0.75) AS p75, max(m) AS max
    FROM (SELECT CAST({_MINUTES_SQL} AS DOUBLE) AS m FROM trips)""",
    after="trips",
)
def _(v: Views):
    return rounded(quality.describe(_durations(v), "minutes"), 6, "mean", "std")


@query(
    "d15_non_null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS row_count, 14 AS column_count FROM trips"
        for c in (
            "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
            "PULocationID", "DOLocationID", "payment_type", "fare_amount", "tip_amount", "total_amount", "event_id",
            "source_year", "source_month",
        )
    ),
    after="trips",
)
def _(v: Views):
    return quality.non_null_counts(v.trips)


@query(
    "d16_histogram",
    f"""SELECT CAST(least(floor((m - lo) / (hi - lo) * 10), 9) AS INT) AS bin, count(*) AS n
    FROM (SELECT CAST({_MINUTES_SQL} AS DOUBLE) AS m FROM trips) CROSS JOIN
    (SELECT min(m) AS lo, max(m) AS hi FROM (SELECT CAST({_MINUTES_SQL} AS DOUBLE) AS m FROM trips))
    WHERE m IS NOT NULL GROUP BY 1""",
    after="trips",
)
def _(v: Views):
    return quality.histogram(_durations(v), "minutes")


@query(
    "d17_sigma_bands",
    f"""SELECT k, count(*) FILTER (abs(m - mu) <= sd * k) AS inside, count(m) AS n,
    round(count(*) FILTER (abs(m - mu) <= sd * k) * 100.0 / count(m), 6) + 0.0 AS percent
    FROM (SELECT CAST({_MINUTES_SQL} AS DOUBLE) AS m FROM trips) CROSS JOIN
    (SELECT avg(m) AS mu, stddev_samp(m) AS sd FROM (SELECT CAST({_MINUTES_SQL} AS DOUBLE) AS m FROM trips))
    CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) GROUP BY k""",
    after="trips",
)
def _(v: Views):
    return rounded(quality.sigma_bands(_durations(v), "minutes"), 6, "percent")


@query(
    "d18_penalty_summary",
    f"""SELECT pickup_location_id, {r6('avg(model_penalty)')} AS mean_penalty, sum(model_penalty) AS total_penalty,
    count(model_penalty) AS n FROM pred GROUP BY 1""",
    after="pred",
)
def _(v: Views):
    return rounded(evaluation.penalty_summary(v.pred, "actual_class", "predicted_class", [ZONE]), 6, "mean_penalty")


_CELLS_SQL = """SELECT a.c AS actual_class, p.c AS predicted_class, count(pred.actual_class) AS n
    FROM (SELECT unnest([0, 1, 2]) AS c) a CROSS JOIN (SELECT unnest([0, 1, 2]) AS c) p
    LEFT JOIN pred ON pred.actual_class = a.c AND pred.predicted_class = p.c GROUP BY 1, 2"""


@query(
    "d19_classification_scores",
    f""", cells AS ({_CELLS_SQL}), per AS (SELECT c,
      sum(n) FILTER (actual_class = c AND predicted_class = c) AS hit, sum(n) FILTER (actual_class = c) AS truth,
      sum(n) FILTER (predicted_class = c) AS said FROM cells CROSS JOIN (SELECT unnest([0, 1, 2]) AS c) GROUP BY c)
    SELECT {r6('(SELECT sum(n) FILTER (actual_class = predicted_class) / sum(n) FROM cells)')} AS accuracy,
    {r6(f'(SELECT sum({sql_penalty("actual_class", "predicted_class")} * n) / sum(n) FROM cells)')} AS mean_penalty,
    (SELECT CAST(sum({sql_penalty("actual_class", "predicted_class")} * n) AS DOUBLE) FROM cells) AS total_penalty,
    (SELECT CAST(sum(n) AS BIGINT) FROM cells) AS n,
    {r6('avg(CASE WHEN said = 0 THEN 0 ELSE hit / said END)')} AS precision_macro,
    {r6('avg(CASE WHEN truth = 0 THEN 0 ELSE hit / truth END)')} AS recall_macro,
    {r6('avg(2 * hit / (truth + said))')} AS macro_f1 FROM per WHERE truth + said > 0""",
    after="pred",
)
def _(v: Views):
    return rounded(evaluation.classification_scores(v.pred, "actual_class", "predicted_class"), 6)


@query("d20_confusion_matrix", _CELLS_SQL, after="pred")
def _(v: Views):
    return evaluation.confusion_cells(v.pred, "actual_class", "predicted_class")


_SAVINGS_SQL = """SELECT pickup_location_id, count(*) AS settled, sum(model_penalty) AS model_cost, sum(baseline_penalty) AS baseline_cost,
    sum(baseline_penalty) - sum(model_penalty) AS net_savings,
    round(CASE WHEN sum(baseline_penalty) > 0 THEN (sum(baseline_penalty) - sum(model_penalty)) / sum(baseline_penalty) * 100 END, 6) + 0.0 AS savings_percent,
    CASE WHEN sum(baseline_penalty) = 0 AND sum(model_penalty) = 0 THEN 'no_cost' WHEN sum(baseline_penalty) = 0 THEN 'cost_without_baseline'
      WHEN sum(model_penalty) < sum(baseline_penalty) THEN 'reduced' WHEN sum(model_penalty) > sum(baseline_penalty) THEN 'increased'
      ELSE 'matched' END AS verdict FROM pred GROUP BY 1"""


@query("d21_net_savings", _SAVINGS_SQL, after="pred")
def _(v: Views):
    return rounded(evaluation.net_savings(v.pred, [ZONE]), 6, "savings_percent")


@query(
    "d22_table_fingerprint",
    """SELECT (SELECT count(*) FROM hourly) AS row_count, pickup_hour_ts, pickup_location_id, trip_count,
    round(avg_distance, 9) + 0.0 AS avg_distance FROM hourly ORDER BY pickup_hour_ts, pickup_location_id LIMIT 5""",
    after="hourly",
)
def _(v: Views):
    summary, sample = fingerprint(v.hourly, [HOUR, ZONE])
    return rounded(sample.crossJoin(F.broadcast(summary.select("row_count"))), 9, "avg_distance")


@query("d22_content_hash")
def _(v: Views):
    """Order-free hash of the mart: equal contents give equal sums."""
    return fingerprint(v.clean, ["event_id"])[0].withColumn("content_hash", F.col("content_hash").cast("string"))


@query(
    "d23_partition_row_counts",
    "SELECT strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date, count(*) AS row_count FROM clean GROUP BY 1",
    after="clean",
)
def _(v: Views):
    return v.clean.groupBy(F.date_format("pickup_datetime", "yyyy-MM-dd").alias("pickup_date")).agg(F.count("*").alias("row_count"))


_WEIGHTS_SQL = """SELECT actual_class, n_class, round(n / (k * n_class), 9) + 0.0 AS weight FROM
    (SELECT actual_class, count(*) AS n_class, sum(count(*)) OVER () AS n, count(*) OVER () AS k FROM pred GROUP BY 1)"""


@query("d24_class_frequency_weights", _WEIGHTS_SQL, after="pred")
def _(v: Views):
    return rounded(evaluation.class_weights(v.pred, "actual_class"), 9, "weight")


# ---- E: windows ---------------------------------------------------------------------


@query(
    "e1_lags",
    "SELECT pickup_location_id, pickup_hour_ts, lag_1h, lag_2h, lag_24h, lag_168h FROM lagged",
    after="lagged",
)
def _(v: Views):
    return series.with_lags(v.area).drop("ride_count")


@query(
    "e2_rolling_means",
    f"SELECT pickup_location_id, pickup_hour_ts, {r6('rolling_6h_mean')} AS rolling_6h_mean, {r6('rolling_24h_mean')} AS rolling_24h_mean FROM lagged",
    after="lagged",
)
def _(v: Views):
    return rounded(series.with_rolling(v.area).select(ZONE, HOUR, "rolling_6h_mean", "rolling_24h_mean"))


@query(
    "e3_rolling_deviations",
    f"SELECT pickup_location_id, pickup_hour_ts, {r6('rolling_6h_std')} AS rolling_6h_std, {r6('rolling_24h_std')} AS rolling_24h_std FROM lagged",
    after="lagged",
)
def _(v: Views):
    return rounded(series.with_rolling(v.area).select(ZONE, HOUR, "rolling_6h_std", "rolling_24h_std"))


_CUMULATIVE = "sum({c}) OVER (PARTITION BY pickup_location_id ORDER BY prediction_hour_ts ROWS UNBOUNDED PRECEDING)"


@query(
    "e4_cumulative_costs",
    f"SELECT pickup_location_id, prediction_hour_ts, {_CUMULATIVE.format(c='model_penalty')} AS model_cumulative, "
    f"{_CUMULATIVE.format(c='baseline_penalty')} AS baseline_cumulative FROM pred",
    after="pred",
)
def _(v: Views):
    return evaluation.cumulative_costs(v.pred).select(
        ZONE, "prediction_hour_ts", "model_cumulative", "baseline_cumulative"
    )


@query("e5_chronological_split", "SELECT pickup_location_id, pickup_hour_ts, split FROM feat", after="feat")
def _(v: Views):
    return v.feat.select(ZONE, HOUR, "split")


@query(
    "e6_latest_row",
    "SELECT user_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
)
def _(v: Views):
    return series.latest_rows(v.events.select("user_id", "ts", "event_type", "value"), "user_id", "ts")


@query(
    "e7_earliest_success",
    "SELECT event_type AS source_filename, 'run-' || CAST(arg_min(event_id, (ts, event_id)) AS VARCHAR) AS ingestion_run_id FROM events WHERE value > 10 GROUP BY 1",
)
def _(v: Views):
    ledger = v.events.select(
        F.col("event_type").alias("source_filename"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("ingestion_run_id"),
        F.when(F.col("value") > 10, "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("ts").alias("finished_at"),
    )
    return medallion.earliest_success(ledger)


FEATURE_SQL = ", ".join(r6(c) + f" AS {c}" if c != "is_weekend" else c for c in FEATURES)


@query(
    "e8_online_features",
    f"SELECT pickup_location_id, pickup_hour_ts, {FEATURE_SQL} FROM lagged WHERE pickup_hour_ts = TIMESTAMP '2024-01-25 13:00:00'",
    after="lagged",
)
def _(v: Views):
    """Features of t+1 from history up to t; the oracle takes them from the training windows."""
    return rounded(series.features_at(v.area, clock.utc_literal(NOW)).select(ZONE, HOUR, *FEATURES))


# ---- F: ranking ---------------------------------------------------------------------


@query(
    "f1_busiest_zone",
    "SELECT pickup_location_id, CAST(sum(ride_count) AS BIGINT) AS total_rides FROM dense GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    after="dense",
)
def _(v: Views):
    return series.busiest_zones(v.dense, 1)


@query(
    "f2_top_zone_hours",
    "SELECT pickup_hour_ts, pickup_location_id, trip_count FROM hourly ORDER BY trip_count DESC, pickup_hour_ts, pickup_location_id LIMIT 10",
    after="hourly",
)
def _(v: Views):
    return v.hourly.select(HOUR, ZONE, "trip_count").orderBy(F.desc("trip_count"), HOUR, ZONE).limit(10)


@query(
    "f3_latest_rows",
    "SELECT pickup_location_id, pickup_hour_ts, ride_count FROM dense ORDER BY pickup_hour_ts DESC, pickup_location_id DESC LIMIT 10",
    after="dense",
)
def _(v: Views):
    return v.dense.orderBy(F.desc(HOUR), F.desc(ZONE)).limit(10)


@query(
    "f4_zone_series",
    "SELECT pickup_location_id, prediction_hour_ts, predicted_class, count(*) OVER () AS n FROM pred WHERE pickup_location_id = 2",
    after="pred",
)
def _(v: Views):
    chosen = scoring.predictions_of(v.pred, 2)
    size = v.pred.filter(F.col(ZONE) == 2).agg(F.count("*").alias("n"))
    return chosen.select(ZONE, "prediction_hour_ts", "predicted_class").crossJoin(F.broadcast(size))


@query(
    "f5_ledger_newest_first",
    "SELECT event_id, ts AS finished_at, event_type AS status FROM events ORDER BY ts DESC",
)
def _(v: Views):
    entries = v.events.select("event_id", F.col("ts").alias("finished_at"), F.col("event_type").alias("status"))
    return entries.orderBy(F.desc("finished_at"), "event_id")


@query(
    "f8_time_range_scan",
    """SELECT ts, user_id, value AS amount FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00'
    AND ts < TIMESTAMP '2024-01-12 18:30:00' ORDER BY ts""",
)
def _(v: Views):
    raw = v.spark.read.parquet(f"{v.folder}/events.parquet")  # zone-less on disk: the filter is pushed as it is
    bounds = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 06:00:00", "2024-01-12 18:30:00")]
    return (
        raw.filter((F.col("ts") >= bounds[0]) & (F.col("ts") < bounds[1]))
        .select("ts", "user_id", F.col("value").alias("amount"))
        .orderBy("ts")
    )


# ---- G: set operations --------------------------------------------------------------


@query("g1_labelled_union", _PUBLISHED_SQL, after="flagged")
def _(v: Views):
    return _published(v)


@query(
    "g2_train_validation_concat",
    "SELECT pickup_location_id, pickup_hour_ts, ride_count FROM feat WHERE split IN ('train', 'val')",
    after="feat",
)
def _(v: Views):
    train, val = (v.feat.filter(F.col("split") == s) for s in ("train", "val"))
    return train.unionByName(val).select(ZONE, HOUR, "ride_count")


# ---- H: scalar functions ------------------------------------------------------------


@query("h1_hour_floor", "SELECT event_id, date_trunc('hour', ts) AS hour_ts FROM events")
def _(v: Views):
    return v.events.select("event_id", clock.hour_floor(F.col("ts")).alias("hour_ts"))


@query(
    "h2_simulated_clock",
    "SELECT o_orderkey, date_trunc('hour', o_orderdate + INTERVAL 17 HOUR + INTERVAL 45 MINUTE - INTERVAL 2 MONTH) AS simulated FROM orders",
)
def _(v: Views):
    now = F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(17), mins=F.lit(45))
    return v.table("orders").select("o_orderkey", clock.simulated_clock(now, 2).alias("simulated"))


@query("h3_next_hour", "SELECT event_id, ts + INTERVAL 1 HOUR AS next_ts FROM events")
def _(v: Views):
    return v.events.select("event_id", clock.next_hour(F.col("ts")).alias("next_ts"))


@query(
    "h4_calendar_parts",
    """SELECT event_id, CAST(hour(ts) AS INT) AS hour_of_day, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
    CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend FROM events""",
)
def _(v: Views):
    return clock.with_calendar(v.events.select("event_id", "ts"), "ts").drop("ts")


@query(
    "h5_cyclical_encoding",
    """SELECT event_id, round(sin(hour(ts) * (2 * pi() / 24)), 6) + 0.0 AS hour_of_day_sin, round(cos(hour(ts) * (2 * pi() / 24)), 6) + 0.0 AS hour_of_day_cos,
    round(sin((isodow(ts) - 1) * (2 * pi() / 7)), 6) + 0.0 AS day_of_week_sin, round(cos((isodow(ts) - 1) * (2 * pi() / 7)), 6) + 0.0 AS day_of_week_cos FROM events""",
)
def _(v: Views):
    return rounded(clock.with_cycles(clock.with_calendar(v.events.select("event_id", "ts"), "ts")).drop("ts", "is_weekend"))


@query("h6_year_month_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def _(v: Views):
    date = F.col("o_orderdate")
    return v.table("orders").select("o_orderkey", clock.year_month_label(F.year(date), F.month(date)).alias("year_month"))


@query("h7_trip_minutes", f"SELECT event_id, CAST({_MINUTES_SQL} AS DOUBLE) AS minutes FROM trips", after="trips")
def _(v: Views):
    return v.trips.select("event_id", quality.trip_minutes().alias("minutes"))


@query("h8_epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def _(v: Views):
    return v.events.select("event_id", clock.epoch_seconds(F.col("ts")).alias("seconds"))


@query(
    "h9_sequence_generators",
    """SELECT m AS month_start, unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS pickup_hour_ts
    FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders)""",
)
def _(v: Views):
    months = v.table("orders").select(F.date_trunc("month", "o_orderdate").alias("month_start")).distinct()
    last = F.col("month_start") + F.make_ym_interval(F.lit(0), F.lit(1)) - F.make_dt_interval(hours=F.lit(1))
    hours = F.sequence("month_start", last, F.make_dt_interval(hours=F.lit(1)))
    return months.select("month_start", F.explode(hours).alias("pickup_hour_ts"))


@query("h10_demand_class", f"SELECT event_id, {sql_class('total_amount', '36', '139')} AS demand_class FROM trips", after="trips")
def _(v: Views):
    return v.trips.select(
        "event_id", cost.demand_class(F.col("total_amount"), F.lit(36.0), F.lit(139.0)).alias("demand_class")
    )


_LABEL_SQL = "CASE c WHEN 0 THEN 'Low' WHEN 1 THEN 'Normal' WHEN 2 THEN 'High' END"


@query(
    "h11_class_labels",
    f"""SELECT event_id, {_LABEL_SQL} AS label, coalesce(CASE c WHEN 0 THEN 'Low Demand' WHEN 1 THEN 'Normal Demand'
    WHEN 2 THEN 'High Demand' END, CAST(c AS VARCHAR), 'Pending Ground Truth') AS caption
    FROM (SELECT event_id, CASE WHEN k < 95 THEN k % 5 END AS c FROM x)""",
    after="x",
)
def _(v: Views):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    cls = F.when(k < 95, k % 5)
    return v.events.select("event_id", text.class_label(cls).alias("label"), text.class_caption(cls).alias("caption"))


def _class_pairs(v: Views):
    """Two small class numbers per event, null now and then."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return v.events.select(
        "event_id", F.when(k < 97, k % 3).alias("actual"), F.when(k > 2, F.floor(k / 3) % 3).cast("int").alias("said")
    )


_PAIRS_SQL = "(SELECT event_id, CASE WHEN k < 97 THEN k % 3 END AS actual, CASE WHEN k > 2 THEN CAST(k // 3 % 3 AS INT) END AS said FROM x)"


@query("h12_asymmetric_penalty", f"SELECT event_id, {sql_penalty('actual', 'said')} AS penalty FROM {_PAIRS_SQL}", after="x")
def _(v: Views):
    return _class_pairs(v).select("event_id", cost.penalty(F.col("actual"), F.col("said")).alias("penalty"))


_PROBS_SQL = """(SELECT event_id, CAST(k % 7 AS DOUBLE) / (k % 7 + k % 5 + k % 3 + 1) AS p0, CAST(k % 5 AS DOUBLE) / (k % 7 + k % 5 + k % 3 + 1) AS p1,
    CAST(k % 3 + 1 AS DOUBLE) / (k % 7 + k % 5 + k % 3 + 1) AS p2 FROM x)"""


@query(
    "h13_cost_sensitive_decision",
    f"""SELECT event_id, CAST(list_position(c, list_min(c)) - 1 AS INT) AS chosen FROM
    (SELECT event_id, [p1 * 15 + p2 * 30, p0 * 10 + p2 * 15, p0 * 20 + p1 * 10] AS c FROM {_PROBS_SQL})""",
    after="x",
)
def _(v: Views):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    total = k % 7 + k % 5 + k % 3 + 1
    probs = [(k % 7) / total, (k % 5) / total, (k % 3 + 1) / total]
    return v.events.select("event_id", cost.cheapest_class(probs).alias("chosen"))


@query(
    "h15_signed_penalty_split",
    """SELECT pickup_location_id, prediction_hour_ts, CASE WHEN actual_class > predicted_class THEN model_penalty ELSE 0.0 END AS underprediction_penalty,
    CASE WHEN predicted_class > actual_class THEN -model_penalty ELSE 0.0 END AS overprediction_penalty FROM pred""",
    after="pred",
)
def _(v: Views):
    return evaluation.signed_costs(v.pred).select(
        ZONE, "prediction_hour_ts", "underprediction_penalty", "overprediction_penalty"
    )


@query(
    "h16_confidence",
    f"SELECT event_id, [p0, p1, p2][said + 1] AS confidence FROM {_PROBS_SQL} JOIN {_PAIRS_SQL} USING (event_id)",
    after="x",
)
def _(v: Views):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    total = k % 7 + k % 5 + k % 3 + 1
    said = F.when(k > 2, F.floor(k / 3) % 3).cast("int")
    probs = [(k % 7) / total, (k % 5) / total, (k % 3 + 1) / total]
    return v.events.select("event_id", cost.confidence(said, probs).alias("confidence"))


@query(
    "h17_lenient_coercion",
    """SELECT event_id, TRY_CAST(t AS DOUBLE) AS number, TRY_CAST(d AS TIMESTAMP) AS stamp FROM
    (SELECT event_id, CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(k AS VARCHAR) END AS t,
    CASE WHEN event_type = 'view' THEN 'someday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS d FROM x)""",
    after="x",
)
def _(v: Views):
    k, kind = F.regexp_extract("props", "([0-9]+)", 1), F.col("event_type")
    number = F.when(kind == "click", "n/a").otherwise(k)
    stamp_text = F.when(kind == "view", "someday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return v.events.select(
        "event_id", text.lenient_number(number).alias("number"), text.lenient_timestamp(stamp_text).alias("stamp")
    )


@query(
    "h18_clean_record",
    """SELECT event_id, CASE WHEN k % 10 <> 0 THEN value END AS value, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts FROM x""",
    after="x",
)
def _(v: Views):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    noisy = F.when(k % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return v.events.select("event_id", text.nan_to_null(noisy).alias("value"), clock.iso_text(F.col("ts")).alias("ts"))


@query("h19_utc_normalisation", "SELECT event_id, ts + INTERVAL 5 HOUR AS utc_ts, ts AS naive_ts FROM events")
def _(v: Views):
    ts = F.col("ts")  # New York is five hours behind in January
    return v.events.select(
        "event_id", clock.as_utc(ts, "America/New_York").alias("utc_ts"), clock.as_utc(ts).alias("naive_ts")
    )


@query("h20_run_hash", "SELECT event_id, substr(sha256('run-' || event_id), 1, 16) AS run_hash FROM events")
def _(v: Views):
    run_id = F.concat(F.lit("run-"), F.col("event_id").cast("string"))
    return v.events.select("event_id", text.run_hash(run_id).alias("run_hash"))


@query("h21_base_name", "SELECT page_id, split_part(url, '/', -1) AS base_name FROM pages")
def _(v: Views):
    return v.table("pages").select("page_id", text.base_name(F.col("url")).alias("base_name"))


@query("h22_parse_timestamp", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def _(v: Views):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return v.events.select("event_id", F.try_to_timestamp(written, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"))


@query(
    "h23_day_parts",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day FROM orders",
)
def _(v: Views):
    return v.table("orders").select("o_orderkey", *[c.alias(n) for n, c in clock.day_parts(F.col("o_orderdate")).items()])


@query(
    "h24_display_text",
    """SELECT event_id, coalesce(format('{:,}', CAST(round(k * 125) AS BIGINT)) || ' Units', 'Awaiting Settlement') AS penalty_text,
    printf('%.2f', k / 128.0 * 100) || '%' AS confidence_text FROM (SELECT event_id, CASE WHEN k < 95 THEN k END AS k FROM x)""",
    after="x",
)
def _(v: Views):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    k = F.when(k < 95, k)
    return v.events.select(
        "event_id", text.penalty_text((k * 125).cast("double")).alias("penalty_text"),
        text.confidence_text(k / 128.0).alias("confidence_text"),
    )


# ---- A: small reads that need no table ----------------------------------------------


@query("a1_parquet_scan", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 100")
def _(v: Views):
    return v.spark.read.parquet(f"{v.folder}/events.parquet").filter("value > 100").select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    "a19_temp_view",
    "SELECT event_type, count(*) AS n, CAST(max(user_id) AS BIGINT) AS top_user FROM events GROUP BY 1",
)
def _(v: Views):
    name = f"events_{uuid.uuid4().hex[:12]}"
    v.events.createTempView(name)
    try:  # the plan is resolved here, so the view needn't outlive it
        return v.spark.sql(f"SELECT event_type, count(*) AS n, max(user_id) AS top_user FROM {name} GROUP BY 1")
    finally:
        v.spark.catalog.dropTempView(name)


@query(
    "a21_bounded_export",
    "SELECT pickup_location_id, count(*) AS n FROM clean GROUP BY 1",
    after="clean",
)
def _(v: Views):
    small = bounded_rows(v.clean.groupBy(ZONE).agg(F.count("*").alias("n")), 1000)
    return v.spark.createDataFrame(small, "pickup_location_id int, n long")


@query(
    "k1_median_imputer",
    ", med AS (SELECT quantile_cont(lag_168h, 0.5) AS m168, quantile_cont(rolling_24h_mean, 0.5) AS m24 FROM lagged) "
    f"SELECT pickup_location_id, pickup_hour_ts, coalesce(lag_168h, m168) AS lag_168h, {r6('coalesce(rolling_24h_mean, m24)')} AS rolling_24h_mean "
    "FROM lagged CROSS JOIN med",
    after="lagged",
)
def _(v: Views):
    """Nulls of warm-up rows filled with exact medians of the column."""
    columns = ["lag_168h", "rolling_24h_mean"]
    wide = series.with_rolling(series.with_lags(v.area)).select(ZONE, HOUR, *columns)
    medians = interpolated_quantiles(wide, {c: [0.5] for c in columns})
    return rounded(wide.na.fill({c: m[0] for c, m in medians.items()}), 6, "rolling_24h_mean")


@query(
    "k11_persistence_baseline",
    "SELECT pickup_location_id, pickup_hour_ts, baseline_predicted_class FROM graded",
    after="graded",
)
def _(v: Views):
    return scoring.with_baseline(v.graded.drop("baseline_predicted_class")).select(ZONE, HOUR, "baseline_predicted_class")

