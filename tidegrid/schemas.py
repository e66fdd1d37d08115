"""Table layouts, column contracts and fixed constants of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(), "long": T.LongType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(), "boolean": T.BooleanType(),
    "metrics": T.MapType(T.StringType(), T.DoubleType()),
}


def ddl(text: str) -> T.StructType:
    """``"name type, name type"`` as a schema; unlike ``StructType.fromDDL`` it needs no session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---- fixed values: column names, types and constants that results must agree on ----

RAW_TRIP = ddl(
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, airport_fee double"
)

LINEAGE = ddl(
    "source_filename string, source_checksum string, source_year int, source_month int, "
    "ingestion_run_id string"
)

MANIFEST = ddl(
    "dataset string, source_filepath string, source_filename string, source_year int, "
    "source_month int, file_size_bytes long, discovered_at_utc timestamp"
)

FEATURES = [
    "lag_1h", "lag_2h", "lag_24h", "lag_168h",
    "rolling_6h_mean", "rolling_6h_std", "rolling_24h_mean", "rolling_24h_std",
    "hour_of_day_sin", "hour_of_day_cos", "day_of_week_sin", "day_of_week_cos", "is_weekend",
]

LEAKAGE_COLUMNS = ["dropoff_datetime", "tip_amount", "fare_amount", "passenger_count", "trip_distance"]

CLASS_LABELS = {0: "Low", 1: "Normal", 2: "High"}
CLASS_CAPTIONS = {0: "Low Demand", 1: "Normal Demand", 2: "High Demand"}
PENDING_CAPTION = "Pending Ground Truth"
UNSETTLED_TEXT = "Awaiting Settlement"

UNDER_COST = 15.0  # per class of under-prediction
OVER_COST = 10.0  # per class of over-prediction
PENALTY_VERSION = "asymmetric-v1"
MODEL_VERSION = "local-v2-cost-sensitive"

FIRST_ZONE, LAST_ZONE = 2, 263
EXCLUDED_ZONES = (1, 264, 265)
MIN_TOTAL = 3.0
MIN_PASSENGERS, MAX_PASSENGERS = 1, 5
CAP_PROBABILITY = 0.999
MAX_DROP_PERCENT = 35.0
TRAIN_FRACTION, VALIDATION_FRACTION = 0.70, 0.15

# ---- tables -------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A declared table: ``namespace.table``, its columns, partition columns and key."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    properties: dict[str, str] = field(default_factory=dict, hash=False, compare=False)

    @property
    def columns(self) -> list[str]:
        """Column order on disk: partition columns last, as file tables store them."""
        plain = [f.name for f in self.schema if f.name not in self.partition_by]
        return plain + list(self.partition_by)


def _fields(*parts: T.StructType | str) -> T.StructType:
    out: list[T.StructField] = []
    for part in parts:
        out.extend((ddl(part) if isinstance(part, str) else part).fields)
    return T.StructType(out)


INGESTION_LEDGER = TableSpec(
    "audit.ingestion_ledger",
    ddl("source_filename string, file_checksum string, ingestion_run_id string, status string, finished_at timestamp"),
)
PUBLISH_LEDGER = TableSpec(
    "audit.silver_publish_ledger",
    ddl(
        "ingestion_run_id string, source_filename string, source_year int, source_month int, status string, "
        "verified_at timestamp, file_checksum string"
    ),
)
COMMIT_LOG = TableSpec(
    "audit.commit_log",
    ddl("committed_at timestamp, table_name string, operation string, slice string, row_count long"),
)
BRONZE = TableSpec(
    "bronze.yellow_taxi_raw",
    _fields(RAW_TRIP, LINEAGE, "ingested_at_utc timestamp"),
    # by file too, so that replacing a slice never touches another file's rows
    partition_by=("source_year", "source_month", "ingestion_run_id", "source_checksum"),
)
SILVER = TableSpec(
    "silver.yellow_taxi_trips",
    _fields(
        "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int, "
        "dropoff_location_id int, trip_distance double, fare_amount double, tip_amount double, "
        "payment_type int, passenger_count int",
        LINEAGE,
        "published_at_utc timestamp, pickup_date date",
    ),
    partition_by=("pickup_date", "ingestion_run_id"),
)
QUARANTINE = TableSpec(
    "quarantine.yellow_taxi_trips",
    _fields(RAW_TRIP, LINEAGE, "wap_run_id string, quarantined_at timestamp"),
    partition_by=("source_year", "source_month", "ingestion_run_id"),
)
UTILISATION = TableSpec(
    "gold.hourly_fleet_utilization",
    ddl(
        "target_year int, target_month int, pickup_hour_ts timestamp, pickup_location_id int, "
        "trip_count bigint, avg_distance double"
    ),
    partition_by=("target_year", "target_month"),
)
OBSERVATIONS = TableSpec(
    "gold.hourly_ml_observations",
    ddl(
        "target_year int, target_month int, pickup_location_id int, pickup_hour_ts timestamp, "
        "ride_count int"
    ),
    partition_by=("target_year", "target_month"),
)
PREDICTION_COLUMNS = ddl(
    "pickup_location_id int, prediction_hour_ts timestamp, scored_at_ts timestamp, model_name string, "
    "model_version string, predicted_class int, predicted_label string, prob_class_0 double, "
    "prob_class_1 double, prob_class_2 double, baseline_predicted_class int, mlflow_run_id string, "
    "feature_window_end_ts timestamp, threshold_q25 double, threshold_q75 double, penalty_version string, "
    "actual_class int, actual_ride_count int, model_penalty double, baseline_penalty double"
)
SETTLEMENT_COLUMNS = ("actual_class", "actual_ride_count", "model_penalty", "baseline_penalty")
PREDICTION_KEY = ("pickup_location_id", "prediction_hour_ts")
# Stored month of the predicted hour: a keyed rewrite touches only the months it scores,
# whereas partitioning by zone would rewrite every zone's whole history each hour.
PREDICTIONS = TableSpec(
    "predictions.hourly_demand_predictions",
    _fields(PREDICTION_COLUMNS, "prediction_month date"),
    partition_by=("prediction_month",),
    keys=PREDICTION_KEY,
)
SERVING = TableSpec(
    "serving.hourly_demand_predictions",
    _fields(
        T.StructType(
            [
                T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
                for f in PREDICTION_COLUMNS
            ]
        ),
        "prediction_month date",
    ),
    partition_by=("prediction_month",),
    keys=PREDICTION_KEY,
)
EXPERIMENTS = TableSpec(
    "ml.experiments",
    ddl(
        "run_id string, run_order int, run_name string, model_family string, tuned boolean, params string, "
        "phase string, metrics metrics, logged_at timestamp"
    ),
)
ALL_TABLES = [
    INGESTION_LEDGER, PUBLISH_LEDGER, COMMIT_LOG, BRONZE, SILVER, QUARANTINE,
    UTILISATION, OBSERVATIONS, PREDICTIONS, SERVING, EXPERIMENTS,
]
