"""Shape of the physical plans: pruning, pushdown, and no single-partition or cross-product steps."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import clock
from tidegrid.operators import evaluation, grid, series
from tidegrid.plans import medallion, report, scoring, training
from tidegrid.registry.views import Views
from tidegrid.schemas import OBSERVATIONS, PREDICTIONS, SILVER
from tidegrid.sources import files


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def views(spark, small):
    return Views(spark, small)


def test_silver_month_prunes_days(spark, lake):
    lake.create(SILVER)
    text = plan(medallion.utilisation(medallion.silver_month(lake, 2024, 1)))
    assert re.search(r"PartitionFilters: \[.*pickup_date", text)
    assert re.search(r"PushedFilters: \[.*pickup_datetime", text)
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "fare_amount" not in schema and "trip_distance" in schema
    assert text.count("partial_count") >= 1  # combined before the shuffle


def test_point_lookup_prunes_month(spark, lake):
    lake.create(PREDICTIONS)
    text = plan(scoring.prediction_at(lake.read(PREDICTIONS), 5, "2024-01-20 07:30:00"))
    assert "prediction_month" in re.search(r"PartitionFilters: (.*)", text).group(1)
    assert "EqualTo(pickup_location_id,5)" in text
    assert "EqualTo(prediction_hour_ts,2024-01-20 07:00:00" in text


def test_scoring_history_prunes_months(spark, lake):
    lake.create(OBSERVATIONS)
    end = clock.utc_literal(dt.datetime(2024, 1, 25, 12))
    history = lake.read(OBSERVATIONS).filter(scoring.month_window(end, clock.next_hour(end)))
    text = plan(series.features_at(history, end))
    assert "target_year" in re.search(r"PartitionFilters: (.*)", text).group(1)
    assert "Window" not in text and "Sort " not in text


def test_day_range_prunes_folders(spark, views, tmp_path):
    path = str(tmp_path / "hive")
    files.write_day_partitioned(views.events, path, "ts")
    bounds = [clock.utc_literal(t) for t in ("2024-01-12 10:00:00", "2024-01-13 10:00:00")]
    frame = files.read_partitioned(spark, path).filter(files.day_range_predicate("ts", *bounds))
    assert "day" in re.search(r"PartitionFilters: (.*)", plan(frame)).group(1)
    assert len(frame.select("_metadata.file_path").distinct().collect()) <= 2


@pytest.mark.parametrize("name", ["feat", "graded", "pred", "clean", "hourly"])
def test_no_cross_product_or_global_window(views, name):
    text = plan(getattr(views, name))
    assert "CartesianProduct" not in text
    # only one-row aggregates may meet in a single partition, never the series themselves
    for exchange in re.findall(r"Exchange\nInput[^\n]*\nArguments: SinglePartition", text):
        assert "ride_count" not in exchange and "total_amount" not in exchange


def test_per_zone_frames_need_no_second_scan(views):
    frames, _ = training.training_frames(views.area)
    alone = training.feature_frames(views.area)
    assert plan(frames).count("Scan parquet") == plan(alone).count("Scan parquet")


def test_windows_share_one_shuffle(spark):
    frame = spark.range(100).select(
        F.col("id").cast("int").alias("pickup_location_id"), F.current_timestamp().alias("pickup_hour_ts"),
        F.lit(1).alias("ride_count"),
    )
    text = plan(series.with_split(series.with_features(frame)))
    assert len(re.findall(r"^\(\d+\) Exchange$", text, flags=re.M)) == 1


def test_settlement_is_one_equi_join(spark, lake):
    lake.create(PREDICTIONS)
    lake.create(OBSERVATIONS)
    due = evaluation.pending_rows(lake.read(PREDICTIONS), clock.utc_literal("2024-01-25 12:00:00"))
    text = plan(evaluation.settle_rows(due, lake.read(OBSERVATIONS)))
    assert "NestedLoop" not in text
    assert "IsNull(actual_class)" in text


def test_report_is_one_shuffle_above_its_input(views):
    rows = views.spark.createDataFrame(views.pred.limit(50).collect(), views.pred.schema)
    text = plan(report.penalty_report(rows, 7))
    assert len(re.findall(r"^\(\d+\) Exchange$", text, flags=re.M)) == 1
    assert "Join" not in text


def test_report_and_grid(views):
    assert "CartesianProduct" not in plan(report.penalty_report(views.pred, 7))
    assert "BroadcastNestedLoopJoin" in plan(grid.zone_hour_grid(
        grid.zone_range(views.spark), grid.month_hours(views.spark, 2024, 1)))
