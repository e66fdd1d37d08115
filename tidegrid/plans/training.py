"""From dense observations to labelled frames and a saved champion model."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.ml import experiments, models
from tidegrid.operators import series
from tidegrid.operators.grid import series_spine
from tidegrid.operators.tables import Lakehouse
from tidegrid.plans.medallion import utc
from tidegrid.schemas import EXPERIMENTS, FEATURES

ZONE = "pickup_location_id"


def feature_frames(observations: DataFrame) -> DataFrame:
    """Complete feature rows of every zone with their chronological split."""
    spine = series_spine(observations)
    ready = series.complete_rows(series.with_features(spine)).filter(F.col("ride_count").isNotNull())
    return series.with_split(ready)


def thresholds_of(frames: DataFrame) -> DataFrame:
    """The thresholds carried by every row of a zone, once per zone."""
    return frames.groupBy(ZONE).agg(F.first("q25").alias("q25"), F.first("q75").alias("q75"))


def training_frames(observations: DataFrame, per_zone: bool = True) -> tuple[DataFrame, DataFrame]:
    """Labelled frames and the thresholds fitted on their training rows only.

    With ``per_zone`` each zone is graded against its own quartiles, else against common ones.
    """
    frames = feature_frames(observations)
    if per_zone:
        graded = series.with_zone_thresholds(frames)
        return series.with_demand_class(graded), thresholds_of(graded)
    thresholds = series.fit_thresholds(frames.filter(F.col("split") == "train"))
    return series.with_demand_class(series.with_thresholds(frames, thresholds)), thresholds


def train_champion(
    lake: Lakehouse, observations: DataFrame, model_path: str, zones: int | None = 1, trials: int = 20,
    at: dt.datetime | None = None, spaces: dict | None = None, defaults: dict | None = None,
    plan: list | None = None,
) -> models.ChampionMetadata:
    """Six experiments, champion by validation penalty, refit on train + validation, one test pass.

    ``zones=k`` trains on the k busiest zones, ``None`` on all of them. The labelled frames are staged
    as a table and persisted from there: every fit iterates over them, and a lost executor re-reads
    its share of the table instead of recomputing the features.
    """
    at = utc(at)
    only = None
    if zones is not None:
        picked = [r[ZONE] for r in series.busiest_zones(observations, zones).collect()]  # k rows
        if not picked:
            raise ValueError("no observations to train on")
        only = picked[0] if zones == 1 else None
        observations = observations.filter(F.col(ZONE).isin(picked))
    frames, thresholds = training_frames(observations, per_zone=zones != 1)
    with lake.staged(frames, "training_frames") as staged:
        kept = staged.persist(StorageLevel.MEMORY_AND_DISK)
        if kept.isEmpty() or not kept.filter(F.col("split").isNull()).isEmpty():
            raise ValueError("no rows, or a zone has too few complete rows to split")
        train, validation = (kept.filter(F.col("split") == s) for s in ("train", "val"))
        results = experiments.run_experiments(train, validation, trials, at, spaces, defaults, plan)
        champion = experiments.choose_champion(results)
        final, test_metrics = experiments.retrain_and_test(champion, kept)
        graded = thresholds_of(kept) if zones != 1 else thresholds
        common = graded.agg(F.avg("q25").alias("q25"), F.avg("q75").alias("q75")).first()
        # thresholds belong to the model: one row, or one per zone
        graded.coalesce(1).write.mode("overwrite").parquet(f"{model_path}/thresholds")
        kept.unpersist()
    spark = lake.spark
    lake.create(EXPERIMENTS)
    lake.append(EXPERIMENTS, experiments.experiment_rows(spark, results, "validation", at))
    tested = experiments.experiment_rows(spark, [champion], "test", at, {champion.run_id: test_metrics})
    lake.append(EXPERIMENTS, tested)
    meta = models.ChampionMetadata(
        pickup_location_id=only, model_name=champion.family, mlflow_run_id=champion.run_id,
        run_name=champion.run_name, tuned=champion.tuned, best_params=champion.params,
        q25=common["q25"], q75=common["q75"], features=list(FEATURES), test_metrics=test_metrics,
        classes=list(final.classes),
    )
    models.save_champion(spark, final, meta, model_path)
    return meta
