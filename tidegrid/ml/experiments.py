"""Seeded search, the six-run experiment matrix, champion choice and the single test pass."""

from __future__ import annotations

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.cost import penalty
from tidegrid.ml import models, search
from tidegrid.ml.models import BOOSTED, FOREST, LABEL, LOGISTIC, FittedModel, TrainingSet
from tidegrid.operators.evaluation import classification_scores
from tidegrid.schemas import EXPERIMENTS

METRICS = ["mean_penalty", "total_penalty", "accuracy", "precision_macro", "recall_macro", "macro_f1"]

# ---- fixed values: search ranges ----
# (kind, low, high, step) for ranges, ("choice", values) for categories
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    LOGISTIC: {"C": ("log", 1e-3, 10.0), "class_weight": ("choice", [None, "balanced"])},
    FOREST: {
        "n_estimators": ("int", 100, 400, 50), "max_depth": ("int", 3, 24, 1),
        "min_samples_leaf": ("int", 1, 10, 1), "class_weight": ("choice", [None, "balanced"]),
    },
    BOOSTED: {
        "n_estimators": ("int", 100, 500, 50), "learning_rate": ("log", 0.01, 0.2),
        "num_leaves": ("int", 15, 127, 1), "max_depth": ("int", 3, 16, 1),
        "min_child_samples": ("int", 10, 80, 1), "subsample": ("uniform", 0.6, 1.0),
        "colsample_bytree": ("uniform", 0.6, 1.0), "class_weight": ("choice", [None, "balanced"]),
    },
}

EXPERIMENT_PLAN = [
    ("EXP-01_LogisticRegression_Baseline", LOGISTIC, False),
    ("EXP-02_LogisticRegression_Tuned", LOGISTIC, True),
    ("EXP-03_RandomForest_Baseline", FOREST, False),
    ("EXP-04_RandomForest_Tuned", FOREST, True),
    ("EXP-05_LightGBM_Baseline", BOOSTED, False),
    ("EXP-06_LightGBM_Tuned", BOOSTED, True),
]


def evaluate(model: FittedModel, frame: DataFrame, prefix: str) -> dict[str, float]:
    """Scores of cost-sensitive predictions on labelled rows."""
    predicted = model.predict(models.as_model_input(frame.filter(F.col(LABEL).isNotNull())))
    row = classification_scores(predicted, LABEL, "predicted_class").first()
    return {f"{prefix}_{m}": None if row[m] is None else float(row[m]) for m in METRICS}


@dataclass(frozen=True)
class Experiment:
    run_id: str
    run_order: int
    run_name: str
    family: str
    tuned: bool
    params: dict
    metrics: dict[str, float]


def penalties(fitted: list[FittedModel], frame: DataFrame) -> list[float]:
    """Mean penalty of each model on the labelled rows of a frame, all in one aggregate."""
    known = models.as_model_input(frame.filter(F.col(LABEL).isNotNull()))
    columns = known.columns
    for i, model in enumerate(fitted):
        known = model.predict(known).withColumnRenamed("predicted_class", f"said_{i}").select(*columns, f"said_{i}")
        columns = [*columns, f"said_{i}"]
    return list(known.agg(*(F.avg(penalty(F.col(LABEL), F.col(f"said_{i}"))).alias(f"loss_{i}") for i in range(len(fitted)))).first())


def tune(family: str, train: TrainingSet, validation: DataFrame, trials: int = 20, space: dict | None = None, parallel: int = 4, base: dict | None = None) -> dict:
    """Parameters of least validation mean penalty by a seeded search; the first of equal trials wins."""
    return tuned_model(family, train, validation, trials, space, parallel, base)[0]


def tuned_model(
    family: str, train: TrainingSet, validation: DataFrame, trials: int = 20, space: dict | None = None, parallel: int = 4, base: dict | None = None
) -> tuple[dict, FittedModel]:
    """What ``tune`` finds, with the model of the winning trial, which needs no second fit.
    A batch of trials is fitted and scored together."""
    best: list[tuple[float, dict, FittedModel]] = []

    def losses(batch: list[dict]) -> list[float]:
        wanted = [{**(base or {}), **p} for p in batch]
        fitted = models.fit_all(family, wanted, train, parallel)
        found = penalties(fitted, validation)
        best[:] = [min([*best, *zip(found, wanted, fitted)], key=lambda trial: trial[0])]
        return found

    search.minimise(space or SEARCH_SPACES[family], losses, trials, models.SEED)
    return best[0][1:]


def run_experiments(
    train: DataFrame, validation: DataFrame, trials: int = 20, started: dt.datetime | None = None,
    spaces: dict[str, dict] | None = None, defaults: dict[str, dict] | None = None, plan=None,
) -> list[Experiment]:
    """Each family once with defaults and once tuned, scored on the validation rows. Runs go side by side."""
    stamp = (started or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")
    numbered = list(enumerate(plan or EXPERIMENT_PLAN, start=1))
    ready = models.TrainingSet(train)

    def run(entry: tuple[int, tuple[str, str, bool]]) -> Experiment:
        order, (name, family, tuned) = entry
        params = dict((defaults or {}).get(family, {}))
        if tuned:
            params, model = tuned_model(family, ready, validation, trials, (spaces or {}).get(family), base=params)
        else:
            model = models.fit(family, params, ready)
        return Experiment(f"run_{stamp}_{name.lower()}", order, name, family, tuned, params, evaluate(model, validation, "val"))

    # the longest run, boosted trees tuned, is last in the plan and starts first
    with ThreadPoolExecutor(max_workers=max(1, len(numbered))) as pool:
        return sorted(pool.map(run, reversed(numbered)), key=lambda e: e.run_order)


def experiment_rows(
    spark: SparkSession, results: list[Experiment], phase: str, at: dt.datetime, metrics: dict[str, dict] | None = None
) -> DataFrame:
    """Run log rows (one per run and phase) for the experiments table."""
    rows = [
        (
            r.run_id, r.run_order, r.run_name, r.family, r.tuned, json.dumps(r.params, sort_keys=True), phase,
            {k: v for k, v in (metrics or {}).get(r.run_id, r.metrics).items() if v is not None}, at,
        )
        for r in results
    ]
    return spark.createDataFrame(rows, EXPERIMENTS.schema)


def ranking(experiments: DataFrame) -> DataFrame:
    """Validation runs, best first; the earlier run wins a tie."""
    loss = F.col("metrics")["val_mean_penalty"]
    return (
        experiments.filter(F.col("phase") == "validation")
        .select("run_order", "run_id", "run_name", "model_family", "tuned", loss.alias("val_mean_penalty"))
        .orderBy("val_mean_penalty", "run_order")
    )


def choose_champion(results: list[Experiment]) -> Experiment:
    if not results:
        raise ValueError("no experiments to choose from")
    return min(results, key=lambda r: (r.metrics["val_mean_penalty"], r.run_order))


def retrain_and_test(champion: Experiment, frames: DataFrame) -> tuple[FittedModel, dict[str, float]]:
    """Fit the champion on train + validation rows and evaluate the test rows once."""
    final = models.fit(champion.family, champion.params, frames.filter(F.col("split").isin("train", "val")))
    return final, evaluate(final, frames.filter(F.col("split") == "test"), "test")
