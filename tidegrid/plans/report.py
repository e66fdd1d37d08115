"""Penalty report, platform audit, idempotency check and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.functions import clock, cost, text
from tidegrid.operators import evaluation, grid, quality, series
from tidegrid.operators.tables import Lakehouse, compare_by_key, fingerprint
from tidegrid.schemas import (
    BRONZE, INGESTION_LEDGER, LEAKAGE_COLUMNS, OBSERVATIONS, PREDICTION_KEY, PREDICTIONS, QUARANTINE, SERVING,
    SILVER, TableSpec,
)
from tidegrid.sources.files import table_layout

ZONE, HOUR = PREDICTION_KEY
REPORT_COLUMNS = [HOUR, "predicted_class", "actual_class", "model_penalty", "baseline_penalty"]


def report_rows(predictions: DataFrame, lookback_days: int | None = None) -> DataFrame:
    """Rows with a usable timestamp inside each zone's lookback, plus signed penalty bars."""
    quality.require_columns(predictions, REPORT_COLUMNS)
    dated = predictions.na.drop(subset=[HOUR])
    return evaluation.signed_costs(series.within_lookback(dated, lookback_days, ZONE, HOUR))


def latest_cards(predictions: DataFrame) -> DataFrame:
    """The newest prediction of each zone as display text."""
    latest = series.latest_rows(predictions.na.drop(subset=[HOUR]), ZONE, HOUR)
    sure = cost.confidence(F.col("predicted_class"), [F.col(f"prob_class_{c}") for c in cost.CLASSES])
    return latest.select(
        ZONE,
        HOUR,
        text.class_caption(F.col("predicted_class")).alias("predicted_state"),
        text.confidence_text(sure).alias("confidence"),
        text.class_caption(F.col("actual_class")).alias("actual_state"),
        text.penalty_text(F.col("model_penalty")).alias("model_loss"),
        text.penalty_text(F.col("baseline_penalty")).alias("baseline_loss"),
    )


def penalty_report(predictions: DataFrame, lookback_days: int | None = None) -> DataFrame:
    """Signed bars, running costs and the savings verdict of every zone's lookback window.

    Lookback, running sums and totals are windows over one partitioning by zone: one scan, one shuffle,
    no join. A zone has one row per hour.
    """
    quality.require_columns(predictions, REPORT_COLUMNS)
    zone = Window.partitionBy(ZONE)
    so_far = zone.orderBy(HOUR).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dated = predictions.na.drop(subset=[ZONE, HOUR])
    if lookback_days is not None:
        recent = F.col(HOUR) >= clock.add_hours(F.max(HOUR).over(zone), -24 * lookback_days)
        dated = dated.withColumn("_recent", recent).filter("_recent").drop("_recent")
    both = F.col("model_penalty").isNotNull() & F.col("baseline_penalty").isNotNull()
    running = {
        f"{who}_cumulative": F.when(both, F.sum(F.when(both, F.col(f"{who}_penalty"))).over(so_far)) for who in ("model", "baseline")
    }
    totals = {name: total.over(zone) for name, total in evaluation.cost_totals().items()}
    return evaluation.with_savings(evaluation.signed_costs(dated).withColumns(running | totals))


# ---- audit --------------------------------------------------------------------------


def lineage_counts(bronze: DataFrame) -> DataFrame:
    keys = ["source_filename", "source_year", "source_month", "ingestion_run_id", "ingested_at_utc"]
    return bronze.groupBy(*keys).agg(F.count("*").alias("record_count"))


def published_counts(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows per run in each of the two outputs of the gate."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("ingestion_run_id").agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "ingestion_run_id", "row_count"
        )

    return counted(silver, SILVER.name).unionByName(counted(quarantine, QUARANTINE.name))


def hour_profile(mart: DataFrame) -> DataFrame:
    """Trips by month and hour of day; the mean of hourly means next to the trip-weighted mean."""
    return mart.groupBy("target_year", "target_month", F.hour("pickup_hour_ts").alias("hour_of_day")).agg(
        F.sum("trip_count").alias("total_trips"),
        F.avg("avg_distance").alias("monthly_avg_distance"),
        (F.sum(F.col("avg_distance") * F.col("trip_count")) / F.sum("trip_count")).alias("weighted_avg_distance"),
    )


def monthly_totals(profile: DataFrame) -> DataFrame:
    from tidegrid.functions.clock import year_month_label

    label = year_month_label(F.col("target_year"), F.col("target_month"))
    return profile.groupBy(label.alias("time_period")).agg(F.sum("total_trips").alias("total_trips"))


def expected_coverage(observations: DataFrame) -> DataFrame:
    """Rows per month next to what a full grid of the zones seen would have."""
    zones = observations.agg(F.count_distinct(ZONE).alias("zones"))
    seen = grid.coverage(observations).crossJoin(F.broadcast(zones))  # one row
    days = F.day(F.last_day(F.to_date(F.concat("year_month", F.lit("-01")))))
    expected = (days * 24 * F.col("zones")).cast("long")
    return seen.select("year_month", "observation_count", expected.alias("expected_count"), (expected - F.col("observation_count")).alias("missing_count"))


def platform_audit(lake: Lakehouse) -> dict[str, DataFrame]:
    """Every audit view of the platform as a frame."""
    return {
        "ingestion_ledger": lake.read(INGESTION_LEDGER).orderBy(F.desc("finished_at"), "source_filename"),
        "bronze_lineage": lineage_counts(lake.read(BRONZE)),
        "published": published_counts(lake.read(SILVER), lake.read(QUARANTINE)),
        "coverage": expected_coverage(lake.read(OBSERVATIONS)),
        "layout": table_layout(lake.read(SILVER), ["pickup_date"]),
        "history": lake.history(),
    }


def audit_findings(lake: Lakehouse) -> DataFrame:
    """One row per check with its measured value, for a single-look verdict."""
    bronze, silver, quarantine = (lake.read(t) for t in (BRONZE, SILVER, QUARANTINE))

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("measured")).select(F.lit(name).alias("check_name"), "measured")

    leaked = set(lake.read(OBSERVATIONS).columns) & set(LEAKAGE_COLUMNS)
    observations = lake.read(OBSERVATIONS)
    return (
        total(bronze, "bronze_rows")
        .unionByName(total(silver, "silver_rows"))
        .unionByName(total(quarantine, "quarantine_rows"))
        .unionByName(total(observations, "observation_rows"))
        .unionByName(
            observations.agg(F.lit(len(leaked)).cast("long").alias("measured")).select(
                F.lit("leakage_columns").alias("check_name"), "measured"
            )
        )
    )


def rebuild_is_idempotent(lake: Lakehouse, spec: TableSpec, rebuild, order: list[str]) -> DataFrame:
    """Fingerprint a table, rebuild it, fingerprint again: one row with both states and the verdict."""
    before, _ = fingerprint(lake.read(spec), order)
    first = before.first()
    rebuild()
    after, _ = fingerprint(lake.read(spec), order)
    return after.select(
        F.lit(first["row_count"]).alias("rows_before"),
        F.col("row_count").alias("rows_after"),
        F.col("content_hash").eqNullSafe(F.lit(first["content_hash"])).alias("same_content"),
    )


def reconcile(lake: Lakehouse) -> DataFrame:
    """Lake against serving copy by key: equal, different, only on one side."""
    left, right = (lake.read(t).drop("prediction_month") for t in (PREDICTIONS, SERVING))
    return compare_by_key(left, right, [ZONE, HOUR]).groupBy("state").agg(F.count("*").alias("n"))
