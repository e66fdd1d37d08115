"""Three model families with a common probability output, and their persistence."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from threading import Lock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.cost import CLASSES, cheapest_class
from tidegrid.ml import boosting, forest
from tidegrid.ml.trees import BinnedFrame, TreeModel, binned_frame
from tidegrid.operators.evaluation import class_weights
from tidegrid.operators.quantile import interpolated_quantiles
from tidegrid.schemas import FEATURES, MODEL_VERSION, PENALTY_VERSION

LOGISTIC, FOREST, BOOSTED = "LogisticRegression", "RandomForest", "LightGBM"  # fixed family names
FAMILIES = (LOGISTIC, FOREST, BOOSTED)
SEED = 42
LABEL = "demand_class"
PROBABILITIES = [f"prob_class_{c}" for c in CLASSES]


@dataclass(frozen=True)
class FittedModel:
    """A family, its parameters, the training medians that fill nulls, and a Spark ML pipeline or a tree ensemble."""

    family: str
    params: dict
    classes: tuple[int, ...]
    features: tuple[str, ...]
    medians: dict[str, float] = field(compare=False)
    pipeline: PipelineModel | None = field(default=None, compare=False)
    trees: TreeModel | None = field(default=None, compare=False)

    def with_probabilities(self, df: DataFrame) -> DataFrame:
        """Add ``prob_class_0..2``; a class unseen in training has a null probability."""
        names = {c: PROBABILITIES[c] for c in self.classes}
        filled = filled_columns(self.features, self.medians)
        if self.trees is not None:
            found = df.withColumn("_p", self.trees.column(list(filled.values()), len(names)))
            scored = found.select(*df.columns, *[F.col("_p")[i].alias(n) for i, n in enumerate(names.values())])
        else:
            vector = vector_to_array("probability")
            found = self.pipeline.transform(df.withColumns(filled))
            scored = found.select(*df.columns, *[vector[c].alias(n) for c, n in names.items()])
        # vectors with a slot for an unseen class are rescaled to sum 1
        total = sum((F.col(n) for n in names.values()), F.lit(0.0))
        unseen = {p: F.lit(None).cast("double") for p in PROBABILITIES if p not in names.values()}
        return scored.withColumns({**{n: F.try_divide(F.col(n), total) for n in names.values()}, **unseen})

    def predict(self, df: DataFrame) -> DataFrame:
        """Probabilities plus the class of least expected cost."""
        return self.with_probabilities(df).withColumn(
            "predicted_class", cheapest_class([F.col(p) for p in PROBABILITIES])
        )


def filled_columns(features: tuple[str, ...] | list[str], medians: dict[str, float]) -> dict[str, Column]:
    """``<feature>__filled`` columns: nulls and NaN replaced by the medians (0 where a feature had no value)."""
    return {f"{f}__filled": F.coalesce(F.nanvl(F.col(f), F.lit(None)), F.lit(medians.get(f, 0.0))) for f in features}


def exact_medians(train: DataFrame, features: list[str]) -> dict[str, float]:
    """Interpolated medians of the known values; features without any are left out."""
    found = interpolated_quantiles(train, {f: [0.5] for f in features})
    return {f: float(m[0]) for f, m in found.items() if m and m[0] is not None}


def as_model_input(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Features as doubles (``is_weekend`` is an int); a label is marked as one of the three classes.

    With the mark every fit has three outputs, also when a class is absent from the training rows.
    """
    out = df.withColumns({f: F.col(f).cast("double") for f in features})
    if LABEL in df.columns:
        values = {"ml_attr": {"type": "nominal", "vals": [str(c) for c in CLASSES]}}
        out = out.withColumn(LABEL, F.col(LABEL).alias(LABEL, metadata=values))
    return out


def _logistic(params: dict, rows: int) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="scaled", labelCol=LABEL, weightCol="_weight", family="multinomial", standardization=False,
        maxIter=int(params.get("max_iter", 2000)), regParam=1.0 / (float(params.get("C", 1.0)) * rows),
    )


def with_weights(train: DataFrame, balanced: bool) -> DataFrame:
    """Row weights: all 1, or n / (k * n_class). The weight table has one row per class."""
    if not balanced:
        return train.withColumn("_weight", F.lit(1.0))
    weights = class_weights(train, LABEL).select(LABEL, F.col("weight").alias("_weight"))
    # joined under another name, so that the label column keeps its class metadata
    weights = weights.withColumnRenamed(LABEL, "_class")
    return train.join(F.broadcast(weights), F.col(LABEL) == F.col("_class")).drop("_class")


class TrainingSet:
    """Labelled rows made ready once for any number of fits: class counts, medians, filled features, binned blocks.

    The caller persists ``train``; fitting iterates over it.
    """

    def __init__(self, train: DataFrame, features: list[str] = FEATURES):
        known = as_model_input(train.filter(F.col(LABEL).isNotNull()), features)
        sizes = {r[LABEL]: r["n"] for r in known.groupBy(LABEL).agg(F.count("*").alias("n")).collect()}
        if not sizes:
            raise ValueError("no labelled rows to fit")
        self.features, self.inputs = tuple(features), [f"{f}__filled" for f in features]
        self.classes = tuple(sorted(sizes))
        self.counts = [sizes[c] for c in self.classes]
        self.medians = exact_medians(known, features)
        self.filled = known.withColumns(filled_columns(features, self.medians))
        self._lock, self._binned = Lock(), None

    def binned(self) -> BinnedFrame:
        with self._lock:
            if self._binned is None:
                self._binned = binned_frame(self.filled, self.inputs, LABEL, self.classes, self.counts)
            return self._binned


def fit_all(family: str, trials: list[dict], train: TrainingSet, parallel: int = 4) -> list[FittedModel]:
    """One model per set of parameters on the same rows.

    Tree ensembles share one binned frame and one job (or one aggregate a step, see ``trees.LOCAL_ROWS``); the
    logistic fits are independent Spark jobs, submitted from a few driver threads.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown model family: {family}")

    def logistic(params: dict) -> PipelineModel:
        stages = [
            VectorAssembler(inputCols=train.inputs, outputCol="assembled"),
            # ML scales by the sample deviation; on n rows this differs by sqrt(n / (n - 1)) only
            StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
            _logistic(params, sum(train.counts)),
        ]
        return Pipeline(stages=stages).fit(with_weights(train.filled, params.get("class_weight") == "balanced"))

    if family == LOGISTIC:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            fitted = [{"pipeline": p} for p in pool.map(logistic, trials)]
    else:
        module = boosting if family == BOOSTED else forest
        fitted = [{"trees": t} for t in module.fit_trees(train.binned(), [module.Settings.of(p, SEED) for p in trials])]
    return [FittedModel(family, p, train.classes, train.features, train.medians, **f) for p, f in zip(trials, fitted)]


def fit(family: str, params: dict, train: DataFrame | TrainingSet, features: list[str] = FEATURES) -> FittedModel:
    return fit_all(family, [params], train if isinstance(train, TrainingSet) else TrainingSet(train, features))[0]


# ---- persistence --------------------------------------------------------------------


@dataclass(frozen=True)
class ChampionMetadata:
    """What scoring needs besides the fitted model."""

    pickup_location_id: int | None
    model_name: str
    mlflow_run_id: str
    run_name: str
    tuned: bool
    best_params: dict
    q25: float
    q75: float
    features: list[str]
    test_metrics: dict
    classes: list[int]
    model_version: str = MODEL_VERSION
    penalty_version: str = PENALTY_VERSION


def save_champion(spark: SparkSession, model: FittedModel, meta: ChampionMetadata, path: str) -> None:
    if model.trees is not None:
        model.trees.save(spark, f"{path}/trees")
    else:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    for name, value in (("metadata", asdict(meta)), ("medians", model.medians)):
        text = spark.createDataFrame([(json.dumps(value),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def load_champion(spark: SparkSession, path: str) -> tuple[FittedModel, ChampionMetadata]:
    meta, medians = (json.loads(spark.read.text(f"{path}/{name}").first()["value"]) for name in ("metadata", "medians"))
    meta = ChampionMetadata(**meta)
    if meta.model_name == LOGISTIC:
        held = {"pipeline": PipelineModel.load(f"{path}/pipeline")}
    else:
        held = {"trees": TreeModel.load(spark, f"{path}/trees")}
    return FittedModel(meta.model_name, meta.best_params, tuple(meta.classes), tuple(meta.features), medians, **held), meta


def probability_columns() -> list[Column]:
    return [F.col(p) for p in PROBABILITIES]
