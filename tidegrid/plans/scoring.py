"""Hourly scoring, keyed publication, settlement and the serving copy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.clock import next_hour, simulated_clock, utc_literal
from tidegrid.functions.cost import demand_class, penalty
from tidegrid.functions.text import class_label, nan_to_null
from tidegrid.ml import models
from tidegrid.operators import evaluation, quality, series
from tidegrid.operators.tables import Lakehouse
from tidegrid.plans.medallion import utc
from tidegrid.schemas import OBSERVATIONS, PREDICTION_COLUMNS, PREDICTIONS, SERVING, SETTLEMENT_COLUMNS

ZONE = "pickup_location_id"


def with_baseline(features: DataFrame) -> DataFrame:
    """Persistence forecast: the class of the last observed hour."""
    return features.withColumn("baseline_predicted_class", demand_class(F.col("lag_1h"), F.col("q25"), F.col("q75")))


def score_records(
    predicted: DataFrame, observations: DataFrame, model_name: str, model_version: str, run_id: str,
    penalty_version: str, scored_at: dt.datetime,
) -> DataFrame:
    """The 20 prediction columns; actuals are attached where the hour has been observed already.

    ``predicted`` carries features, thresholds, probabilities, ``predicted_class`` and the baseline.
    """
    seen = observations.select(ZONE, "pickup_hour_ts", F.col("ride_count").alias("actual_ride_count"))
    actual = demand_class(F.col("actual_ride_count"), F.col("q25"), F.col("q75"))
    out = predicted.join(seen, [ZONE, "pickup_hour_ts"], "left").withColumn("actual_class", actual)
    return out.select(
        ZONE,
        F.col("pickup_hour_ts").alias("prediction_hour_ts"),
        F.lit(scored_at).alias("scored_at_ts"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        "predicted_class",
        class_label(F.col("predicted_class")).alias("predicted_label"),
        *models.PROBABILITIES,
        "baseline_predicted_class",
        F.lit(run_id).alias("mlflow_run_id"),
        "feature_window_end_ts",
        F.col("q25").alias("threshold_q25"),
        F.col("q75").alias("threshold_q75"),
        F.lit(penalty_version).alias("penalty_version"),
        "actual_class",
        F.col("actual_ride_count").cast("int").alias("actual_ride_count"),
        penalty(F.col("actual_class"), F.col("predicted_class")).alias("model_penalty"),
        penalty(F.col("actual_class"), F.col("baseline_predicted_class")).alias("baseline_penalty"),
    )


def with_month(predictions: DataFrame) -> DataFrame:
    """The stored month of the predicted hour, by which prediction tables are partitioned."""
    return predictions.withColumn("prediction_month", F.trunc("prediction_hour_ts", "month"))


def publish_predictions(lake: Lakehouse, records: DataFrame) -> None:
    """Keyed replace; a re-score never erases settled values."""
    lake.upsert(PREDICTIONS, with_month(records), F.col("scored_at_ts"), keep_known=SETTLEMENT_COLUMNS)


def month_window(first: Column, last: Column) -> Column:
    """Partition predicate on (target_year, target_month) for an hour range."""
    number = F.col("target_year") * 12 + F.col("target_month")
    return number.between(F.year(first) * 12 + F.month(first), F.year(last) * 12 + F.month(last))


def score_features(lake: Lakehouse, features: DataFrame, observations: DataFrame, model_path: str, at: dt.datetime) -> DataFrame:
    """Prediction records of feature rows by the champion at ``model_path``; rows with a missing feature or threshold get none."""
    model, meta = models.load_champion(lake.spark, model_path)
    thresholds = lake.spark.read.parquet(f"{model_path}/thresholds")
    per_zone = ZONE in thresholds.columns
    if meta.pickup_location_id is not None:
        features = features.filter(F.col(ZONE) == meta.pickup_location_id)
    ready = series.complete_rows(series.with_thresholds(features, thresholds, [ZONE] if per_zone else None))
    ready = ready.filter(F.col("q25").isNotNull())
    predicted = with_baseline(model.predict(models.as_model_input(ready)))
    return score_records(
        predicted, observations, meta.model_name, meta.model_version, meta.mlflow_run_id, meta.penalty_version, at
    )


def score_hour(
    lake: Lakehouse, model_path: str, now: dt.datetime, months_back: int = 2, at: dt.datetime | None = None
) -> DataFrame:
    """Predict the hour after the shifted clock for every zone of the model and publish it."""
    at = utc(at)
    end = simulated_clock(utc_literal(now), months_back)
    observations = lake.read(OBSERVATIONS).filter(month_window(end - F.make_dt_interval(days=F.lit(8)), next_hour(end)))
    records = score_features(lake, series.features_at(observations, end), observations, model_path, at)
    publish_predictions(lake, records)
    return lake.read(PREDICTIONS).filter(F.col("prediction_hour_ts") == next_hour(end))


def backfill(
    lake: Lakehouse, model_path: str, first: dt.datetime, last: dt.datetime, months_back: int = 2,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Score every run hour in [first, last] in one job instead of one run per hour."""
    at = utc(at)
    start = next_hour(simulated_clock(utc_literal(first), months_back))
    end = next_hour(simulated_clock(utc_literal(last), months_back))
    observations = lake.read(OBSERVATIONS).filter(month_window(start - F.make_dt_interval(days=F.lit(8)), end))
    records = score_features(lake, series.features_between(observations, start, end), observations, model_path, at)
    publish_predictions(lake, records)
    return lake.read(PREDICTIONS).filter(F.col("prediction_hour_ts").between(start, end))


def settle(lake: Lakehouse, now: dt.datetime) -> None:
    """Fill in actuals and penalties of due predictions; the lake is the copy of record."""
    pending = evaluation.pending_rows(lake.read(PREDICTIONS), utc_literal(now))
    settled = evaluation.settle_rows(pending, lake.read(OBSERVATIONS))
    lake.upsert(PREDICTIONS, settled, F.col("scored_at_ts"))


def serving_rows(predictions: DataFrame) -> DataFrame:
    """Serving layout: required columns in order, NaN as null, one row per key."""
    names = PREDICTION_COLUMNS.names
    ordered = quality.require_columns(predictions, names)
    doubles = {f.name: nan_to_null(F.col(f.name)) for f in PREDICTION_COLUMNS if f.dataType.typeName() == "double"}
    return ordered.withColumns(doubles)


def sync_serving(lake: Lakehouse, first: dt.datetime, last: dt.datetime, zone: int | None = None) -> None:
    """Upsert the predictions of an hour range (and optionally one zone) into the serving table."""
    hour = F.col("prediction_hour_ts")
    month = F.col("prediction_month").between(F.lit(first.date().replace(day=1)), F.lit(last.date()))
    chosen = lake.read(PREDICTIONS).filter(month & hour.between(utc_literal(first), utc_literal(last)))
    if zone is not None:
        chosen = chosen.filter(F.col(ZONE) == zone)
    unique = quality.require_unique(chosen, [ZONE, "prediction_hour_ts"])
    lake.upsert(SERVING, with_month(serving_rows(unique)), F.col("scored_at_ts"))


def prediction_at(predictions: DataFrame, zone: int, hour: dt.datetime | str) -> DataFrame:
    """Point lookup; the hour is floored first and the month folder pruned."""
    target = F.date_trunc("hour", utc_literal(hour))
    found = predictions.filter((F.col(ZONE) == zone) & (F.col("prediction_hour_ts") == target))
    if "prediction_month" in predictions.columns:
        found = found.filter(F.col("prediction_month") == F.trunc(target, "month"))
    return found


def predictions_of(predictions: DataFrame, zone: int) -> DataFrame:
    return predictions.filter(F.col(ZONE) == zone).orderBy("prediction_hour_ts")
