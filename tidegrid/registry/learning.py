"""Model fitting, search, persistence and scoring on the derived area frames, at the library's defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions import clock
from tidegrid.functions.cost import cheapest_class
from tidegrid.ml import experiments, models, zones
from tidegrid.operators import evaluation, series
from tidegrid.plans import scoring, training
from tidegrid.registry.core import query, rounded
from tidegrid.registry.lake import AT
from tidegrid.registry.relational import HOUR, ZONE
from tidegrid.registry.views import MONTH, YEAR, Views
from tidegrid.schemas import EXPERIMENTS, FEATURES, OBSERVATIONS, PREDICTIONS


def labelled(v: Views) -> DataFrame:
    """Labelled frames as a written table, since a fit passes over them many times."""
    return written(v, training.training_frames(v.area)[0])


def written(v: Views, frames: DataFrame) -> DataFrame:
    path = v.scratch("frames")
    frames.write.parquet(path)
    return v.spark.read.parquet(path)


def _split(frames: DataFrame, name: str) -> DataFrame:
    return frames.filter(F.col("split") == name)


def _fitted_predictions(v: Views, family: str) -> DataFrame:
    frames = labelled(v)
    model = models.fit(family, {}, _split(frames, "train"))
    predicted = model.predict(models.as_model_input(_split(frames, "val")))
    return predicted.select(ZONE, HOUR, "demand_class", *models.PROBABILITIES, "predicted_class")


@query(
    "k2_standardised_features",
    f"""SELECT feature_no, round(avg(z), 6) + 0.0 AS mean, round(stddev_samp(z), 6) + 0.0 AS std FROM (
    SELECT feature_no, coalesce((v - avg(v) OVER (PARTITION BY feature_no)) / nullif(stddev_samp(v) OVER (PARTITION BY feature_no), 0), 0) AS z
    FROM (SELECT unnest(range({len(FEATURES)}))::INT AS feature_no, unnest([{", ".join(f"{f}::DOUBLE" for f in FEATURES)}]) AS v FROM feat)) GROUP BY 1""",
    after="feat",
)
def _(v: Views):
    """Training features with mean 0 and deviation 1; the means and deviations of the result per feature."""
    ready = models.as_model_input(series.complete_rows(v.feat))
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True),
    ]
    z = vector_to_array("z")
    scaled = Pipeline(stages=stages).fit(ready).transform(ready).select(F.posexplode(z).alias("feature_no", "value"))
    return rounded(
        scaled.groupBy("feature_no").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


def _decisions(predicted: DataFrame) -> DataFrame:
    """What holds for any fitted model: one row per labelled hour, probabilities that sum to 1, and the
    class of least expected penalty (15 a class too low, 10 a class too high) chosen."""
    p = [F.coalesce(F.col(c), F.lit(0.0)) for c in models.PROBABILITIES]
    expected = [sum((p[a] * (15.0 * max(a - c, 0) + 10.0 * max(c - a, 0)) for a in range(3)), F.lit(0.0)) for c in range(3)]
    chosen = F.get(F.array(*expected), F.col("predicted_class"))
    return predicted.select(
        ZONE, HOUR, F.col("demand_class").cast("int").alias("demand_class"), (F.abs(p[0] + p[1] + p[2] - 1) < 1e-9).alias("sums_to_one"),
        (chosen <= F.least(*expected) + 1e-9).alias("cheapest"),
    )


_DECISIONS = "SELECT pickup_location_id, pickup_hour_ts, actual_class AS demand_class, true AS sums_to_one, true AS cheapest FROM graded WHERE split = 'val'"


@query("k3_logistic_regression", _DECISIONS, after="graded")
def _(v: Views):
    return _decisions(_fitted_predictions(v, models.LOGISTIC))


@query("k4_random_forest", _DECISIONS, after="graded")
def _(v: Views):
    return _decisions(_fitted_predictions(v, models.FOREST))


@query("k5_boosted_trees", _DECISIONS, after="graded")
def _(v: Views):
    return _decisions(_fitted_predictions(v, models.BOOSTED))


@query(
    "k6_balanced_row_weights",
    """SELECT pickup_location_id, pickup_hour_ts, round((SELECT count(*) FROM graded WHERE split = 'train') /
    ((SELECT count(DISTINCT actual_class) FROM graded WHERE split = 'train') * count(*) OVER (PARTITION BY actual_class)), 9) + 0.0 AS weight
    FROM graded WHERE split = 'train'""",
    after="graded",
)
def _(v: Views):
    frames, _ = training.training_frames(v.area)
    weighted = models.with_weights(_split(frames, "train"), balanced=True)
    return rounded(weighted.select(ZONE, HOUR, F.col("_weight").alias("weight")), 9, "weight")


@dataclass(frozen=True)
class Trained:
    """One run of the whole experiment matrix: where its champion and its run log are kept."""

    champion: str
    log: str
    meta: models.ChampionMetadata


_TRAINED: dict[tuple, Trained] = {}


def trained(v: Views) -> Trained:
    """The matrix over all areas at full settings, run once per session and content of the observations."""
    columns = [F.xxhash64(ZONE, HOUR, "ride_count")]
    content = v.area.agg(F.count("*"), F.bit_xor(*columns), F.sum(F.shiftright(columns[0], 20))).first()
    key = (v.spark.sparkContext.applicationId, *content)
    if key not in _TRAINED:
        lake = observed_lake(v)
        champion, log = v.scratch("champion"), v.scratch("runs")
        meta = training.train_champion(lake, lake.read(OBSERVATIONS), champion, None, at=AT)
        lake.read(EXPERIMENTS).coalesce(1).write.parquet(log)
        _TRAINED[key] = Trained(champion, log, meta)
    return _TRAINED[key]


def run_log(v: Views) -> DataFrame:
    return v.spark.read.parquet(trained(v).log)


def observed_lake(v: Views):
    """A lake that holds the observations of all areas."""
    lake = v.lake()
    for spec in (OBSERVATIONS, PREDICTIONS, EXPERIMENTS):
        lake.create(spec)
    lake.replace_slices(OBSERVATIONS, v.area.withColumns({"target_year": F.lit(YEAR), "target_month": F.lit(MONTH)}))
    return lake


def _metrics(phase: str) -> list:
    return [F.col("metrics")[f"{phase}_{m}"].alias(m) for m in experiments.METRICS]


@query("k7_parameter_search")
def _(v: Views):
    """Each family tuned by twenty trials; validation scores and parameters of the best one."""
    tuned = run_log(v).filter("tuned and phase = 'validation'")
    params = F.from_json("params", "C double, class_weight string")
    return tuned.select("model_family", "params", params["C"].alias("C"), params["class_weight"].alias("class_weight"), *_metrics("val"))


@query("k8_experiment_matrix")
def _(v: Views):
    """Three families, default and tuned, from the experiments table, ranked."""
    return experiments.ranking(run_log(v))


_PLAN = ", ".join(f"({i}, '{name}', '{family}', {str(tuned).lower()})" for i, (name, family, tuned) in enumerate(experiments.EXPERIMENT_PLAN, 1))


@query(
    "k8_matrix_facts",
    f"""SELECT CAST(p.run_order AS INT) AS run_order, p.run_name, p.model_family, p.tuned, s.phase, g.n AS scored, true AS in_range, true AS no_better_run
    FROM (VALUES {_PLAN}) AS p(run_order, run_name, model_family, tuned) CROSS JOIN (VALUES ('validation', 'val')) AS s(phase, split)
    JOIN (SELECT split, count(*) AS n FROM graded GROUP BY 1) g ON g.split = s.split""",
    after="graded",
)
def _(v: Views):
    """What holds for any run of the matrix: every planned run scored on all validation rows, and none better than the champion."""
    log = run_log(v).filter("phase = 'validation'")
    mean, total = F.col("metrics")["val_mean_penalty"], F.col("metrics")["val_total_penalty"]
    champion = log.filter(F.col("run_name") == trained(v).meta.run_name).agg(F.min(mean)).first()[0]  # one run
    shares = [F.col("metrics")[f"val_{m}"].between(0, 1) for m in ("accuracy", "precision_macro", "recall_macro", "macro_f1")]
    in_range = shares[0] & shares[1] & shares[2] & shares[3] & mean.between(0, 30)
    scored = F.when(mean > 0, F.round(total / mean)).otherwise(F.lit(None)).cast("long")
    return log.select("run_order", "run_name", "model_family", "tuned", "phase", scored.alias("scored"), in_range.alias("in_range"), (mean >= champion).alias("no_better_run"))


@query("f6_champion_choice")
def _(v: Views):
    """The six runs compared; least validation penalty first, earlier run on ties."""
    return experiments.ranking(run_log(v)).limit(1)


@query("k9_retrain_and_test")
def _(v: Views):
    """The champion of the six runs refitted on train + validation, scored once on the test rows."""
    tested = run_log(v).filter("phase = 'test'")
    return tested.select(F.explode("metrics").alias("metric", "value"))


@query("k10_champion_round_trip")
def _(v: Views):
    """A saved and reloaded champion with thresholds, features and penalty version."""
    model, meta = models.load_champion(v.spark, trained(v).champion)
    row = (meta.model_name, meta.penalty_version, meta.pickup_location_id, meta.q25, meta.q75, len(meta.features), list(model.classes))
    return v.spark.createDataFrame(
        [row], "model_name string, penalty_version string, zone int, q25 double, q75 double, features int, classes array<int>"
    )


@query(
    "h14_probability_alignment",
    "SELECT pickup_location_id, count(*) AS n, count(*) AS sums_to_one FROM graded WHERE split = 'val' GROUP BY 1",
    after="graded",
)
def _(v: Views):
    """Probabilities on the fixed class axis; absent classes are null and count 0 in the sum."""
    predicted = _fitted_predictions(v, models.LOGISTIC)
    total = sum((F.coalesce(F.col(p), F.lit(0.0)) for p in models.PROBABILITIES), F.lit(0.0))
    return predicted.groupBy(ZONE).agg(
        F.count("*").alias("n"), F.count_if(F.abs(total - 1) < 1e-9).alias("sums_to_one")
    )


SCORED = """SELECT pickup_location_id, pickup_hour_ts AS prediction_hour_ts, baseline_predicted_class, feature_window_end_ts,
    threshold_q25, threshold_q75, CAST(actual_class AS INT) AS actual_class, ride_count AS actual_ride_count FROM
    (SELECT pickup_location_id, prediction_hour_ts AS pickup_hour_ts, baseline_predicted_class, feature_window_end_ts,
     threshold_q25, threshold_q75, actual_class, actual_ride_count AS ride_count FROM pred) WHERE {where}"""
SCORED_COLUMNS = [
    ZONE, "prediction_hour_ts", "baseline_predicted_class", "feature_window_end_ts", "threshold_q25", "threshold_q75",
    "actual_class", "actual_ride_count",
]


@query("k12_score_record", SCORED.format(where="pickup_hour_ts = TIMESTAMP '2024-01-25 13:00:00'"), after="pred")
def _(v: Views):
    """The model-independent part of the 20-column record for one hour of every area."""
    end = clock.utc_literal("2024-01-25 12:00:00")
    features = series.with_thresholds(series.features_at(v.area, end), v.thresholds, [ZONE])
    probs = {p: F.lit(1 / 3) for p in models.PROBABILITIES}
    predicted = scoring.with_baseline(features.withColumns({**probs, "predicted_class": F.lit(1)}))
    return scoring.score_records(predicted, v.area, "m", "v", "r", "asymmetric-v1", AT).select(*SCORED_COLUMNS)


@query("k13_per_zone_models")
def _(v: Views):
    """Own thresholds and an own model per zone, all zones fitted at once; penalties on the validation rows."""
    frames = labelled(v)
    fitted = zones.fit_zones(_split(frames, "train"), FEATURES)
    scored = zones.zone_probabilities(_split(frames, "val"), fitted, FEATURES, models.PROBABILITIES)
    predicted = scored.withColumn("predicted_class", cheapest_class([F.col(p) for p in models.PROBABILITIES]))
    return evaluation.penalty_summary(predicted, "demand_class", "predicted_class", [ZONE])


@query(
    "k13_zone_model_facts",
    """SELECT pickup_location_id, count(*) AS n, true AS settled, true AS shares_agree FROM graded WHERE split = 'train' GROUP BY 1""",
    after="graded",
)
def _(v: Views):
    """What holds at every zone's optimum: fitted on all its rows, and mean probabilities equal to the classes' shares."""
    train = _split(labelled(v), "train")
    fitted = zones.fit_zones(train, FEATURES)
    scored = zones.zone_probabilities(train, fitted, FEATURES, models.PROBABILITIES)
    gaps = [F.abs(F.avg(p) - F.avg((F.col("demand_class") == c).cast("double"))) for c, p in enumerate(models.PROBABILITIES)]
    shares = scored.groupBy(ZONE).agg((F.greatest(*gaps) < 1e-4).alias("shares_agree"))
    return fitted.join(shares, ZONE).select(ZONE, "n", (F.col("steps") < zones.MOST_STEPS).alias("settled"), "shares_agree")


@query("l6_train_champion")
def _(v: Views):
    return run_log(v).withColumn("champion", F.lit(trained(v).meta.run_name)).select(
        "run_name", "phase", "champion", F.col("metrics")["val_mean_penalty"].alias("val_mean_penalty"),
        F.col("metrics")["test_mean_penalty"].alias("test_mean_penalty"),
    )


@query("l7_score_hour", SCORED.format(where="pickup_hour_ts = TIMESTAMP '2024-01-25 13:00:00'"), after="pred")
def _(v: Views):
    """The champion scores the hour after the clock moved back two months; a re-run replaces it."""
    lake, path = observed_lake(v), trained(v).champion
    for _ in range(2):
        scored = scoring.score_hour(lake, path, dt.datetime(2024, 3, 25, 12, 34), 2, AT)
    return scored.select(*SCORED_COLUMNS)


@query(
    "i5_hour_range_backfill",
    SCORED.format(where="pickup_hour_ts BETWEEN TIMESTAMP '2024-01-20 01:00:00' AND TIMESTAMP '2024-01-23 00:00:00'"),
    after="pred",
)
def _(v: Views):
    """Seventy-two run hours scored by one job with the champion."""
    first, last = dt.datetime(2024, 3, 20, 0), dt.datetime(2024, 3, 22, 23)
    return scoring.backfill(observed_lake(v), trained(v).champion, first, last, 2, AT).select(*SCORED_COLUMNS)
