"""Registration, result normalisation and the oracle's shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.registry.views import Views
from tidegrid.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_RULES = {
    "complete": " AND ".join(
        f"{c} IS NOT NULL"
        for c in (
            "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
            "total_amount", "trip_distance", "passenger_count",
        )
    ),
    "positive_duration": "date_trunc('second', tpep_dropoff_datetime) > date_trunc('second', tpep_pickup_datetime)",
    "amount_in_range": "total_amount >= 3.0 AND total_amount <= cap_total",
    "distance_in_range": "trip_distance > 0 AND trip_distance <= cap_distance",
    "known_zone": "PULocationID NOT IN (1, 264, 265)",
    "pickup_in_month": "tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'",
    "passengers_in_range": "passenger_count >= 1 AND passenger_count <= 5",
}
_FLAGS = ", ".join(f"coalesce({sql}, false) AS {name}" for name, sql in _RULES.items())

_FRAME = "OVER (PARTITION BY pickup_location_id ORDER BY pickup_hour_ts ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"


def _rolling(w: int) -> str:
    frame = _FRAME.format(w=w)
    return ", ".join(
        f"CASE WHEN count(ride_count) {frame} = {w} THEN {fn}(ride_count) {frame} END AS rolling_{w}h_{name}"
        for fn, name in (("avg", "mean"), ("stddev_samp", "std"))
    )


_LAGS = ", ".join(
    f"CAST(lag(ride_count, {k}) OVER (PARTITION BY pickup_location_id ORDER BY pickup_hour_ts) AS DOUBLE) AS lag_{k}h"
    for k in (1, 2, 24, 168)
)
_CALENDAR = """
    sin(hour(pickup_hour_ts) * (2 * pi() / 24)) AS hour_of_day_sin,
    cos(hour(pickup_hour_ts) * (2 * pi() / 24)) AS hour_of_day_cos,
    sin((isodow(pickup_hour_ts) - 1) * (2 * pi() / 7)) AS day_of_week_sin,
    cos((isodow(pickup_hour_ts) - 1) * (2 * pi() / 7)) AS day_of_week_cos,
    CAST(CASE WHEN isodow(pickup_hour_ts) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend"""


def sql_class(value: str, q25: str = "q25", q75: str = "q75") -> str:
    return (
        f"CAST(CASE WHEN {value} IS NULL THEN NULL WHEN {value} < {q25} THEN 0 "
        f"WHEN {value} <= {q75} THEN 1 ELSE 2 END AS INT)"
    )


def sql_penalty(actual: str, predicted: str) -> str:
    gap = f"({actual} - {predicted})"
    return f"CAST(CASE WHEN {gap} >= 0 THEN 15.0 * {gap} WHEN {gap} < 0 THEN -10.0 * {gap} END AS DOUBLE)"


# each fragment may use all earlier ones
_CTES: dict[str, str] = {
    "x": "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events",
    "trips": """SELECT CAST(event_id % 2 + 1 AS INT) AS VendorID,
        CASE WHEN k = 97 THEN ts - INTERVAL 31 DAY ELSE ts END AS tpep_pickup_datetime,
        CASE WHEN k = 98 THEN NULL WHEN k = 97 THEN ts - INTERVAL 31 DAY + INTERVAL 10 MINUTE
             ELSE ts + to_minutes(k) END AS tpep_dropoff_datetime,
        CASE WHEN k = 96 THEN NULL ELSE CAST(k % 6 AS DOUBLE) END AS passenger_count,
        CAST(value / 10 AS DOUBLE) AS trip_distance,
        CAST(user_id % 20 + 1 AS INT) AS PULocationID,
        CAST((user_id + k) % 20 + 1 AS INT) AS DOLocationID,
        CAST(k % 4 + 1 AS INT) AS payment_type,
        value AS fare_amount, value * 0.2 AS tip_amount, value + 2 AS total_amount,
        event_id, 2024 AS source_year, 1 AS source_month FROM x""",
    "caps": """SELECT quantile_disc(total_amount, 0.999) AS cap_total,
        quantile_disc(trip_distance, 0.999) AS cap_distance FROM trips""",
    "ruled": f"SELECT trips.*, {_FLAGS} FROM trips CROSS JOIN caps",
    "flagged": f"SELECT *, ({' AND '.join(_RULES)}) AS is_valid FROM ruled",
    "clean": """SELECT event_id, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
        PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id, trip_distance, fare_amount,
        tip_amount, payment_type, CAST(passenger_count AS INT) AS passenger_count FROM flagged WHERE is_valid""",
    "hourly": """SELECT date_trunc('hour', pickup_datetime) AS pickup_hour_ts, pickup_location_id,
        count(*) AS trip_count, avg(trip_distance) AS avg_distance FROM clean GROUP BY 1, 2""",
    "dense": """SELECT CAST(z.z AS INT) AS pickup_location_id, h.h AS pickup_hour_ts,
        CAST(coalesce(a.trip_count, 0) AS INT) AS ride_count
        FROM (SELECT unnest(range(2, 21)) AS z) z
        CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00',
            INTERVAL 1 HOUR)) AS h) h
        LEFT JOIN hourly a ON a.pickup_location_id = z.z AND a.pickup_hour_ts = h.h""",
    "area": """SELECT pickup_location_id % 3 AS pickup_location_id, pickup_hour_ts,
        CAST(sum(ride_count) AS INT) AS ride_count FROM dense GROUP BY 1, 2""",
    "lagged": f"SELECT *, {_LAGS}, {_rolling(6)}, {_rolling(24)}, {_CALENDAR} FROM area",
    "numbered": """SELECT *, row_number() OVER (PARTITION BY pickup_location_id ORDER BY pickup_hour_ts) - 1 AS rn,
        count(*) OVER (PARTITION BY pickup_location_id) AS cn FROM lagged WHERE lag_168h IS NOT NULL""",
    "feat": """SELECT * EXCLUDE (rn, cn), CASE WHEN rn < floor(cn * 0.7::DOUBLE) THEN 'train'
        WHEN rn < floor(cn * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM numbered""",
    "thr": """SELECT pickup_location_id, quantile_cont(ride_count, 0.25) AS q25, quantile_cont(ride_count, 0.75) AS q75
        FROM feat WHERE split = 'train' GROUP BY 1""",
    "graded": f"""SELECT feat.*, q25, q75, {sql_class('ride_count')} AS actual_class,
        {sql_class('lag_1h')} AS baseline_predicted_class, {sql_class('lag_168h')} AS predicted_class
        FROM feat JOIN thr USING (pickup_location_id)""",
    "pred": f"""SELECT pickup_location_id, pickup_hour_ts AS prediction_hour_ts, predicted_class,
        CASE predicted_class WHEN 0 THEN 0.8 ELSE 0.1 END::DOUBLE AS prob_class_0,
        CASE predicted_class WHEN 1 THEN 0.8 ELSE 0.1 END::DOUBLE AS prob_class_1,
        CASE predicted_class WHEN 2 THEN 0.8 ELSE 0.1 END::DOUBLE AS prob_class_2,
        baseline_predicted_class, pickup_hour_ts - INTERVAL 1 HOUR AS feature_window_end_ts,
        q25 AS threshold_q25, q75 AS threshold_q75, actual_class, ride_count AS actual_ride_count,
        {sql_penalty('actual_class', 'predicted_class')} AS model_penalty,
        {sql_penalty('actual_class', 'baseline_predicted_class')} AS baseline_penalty FROM graded""",
}


def chain(last: str, body: str) -> str:
    """``body`` after the fragments up to ``last``."""
    names = list(_CTES)
    used = names[: names.index(last) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in used) + "\n" + body


def query(name: str, oracle: str | None = None, after: str | None = None):
    """Register ``fn(views)``; instants leave as zone-less timestamps, as the oracle has them."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_utc(spark)
            df = fn(Views(spark, folder))
            zoned = {n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"}
            return df.withColumns(zoned) if zoned else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = chain(after, oracle) if after else oracle
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round doubles whose last bits depend on summation order; ``+ 0.0`` turns -0.0 into 0.0."""
    chosen = columns or tuple(n for n, t in df.dtypes if t == "double")
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in chosen})


def r6(sql: str, digits: int = 6) -> str:
    return f"round({sql}, {digits}) + 0.0"
