"""One logistic model per zone, all fitted at once: Newton steps whose sums are one grouped aggregate for every zone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.cost import CLASSES
from tidegrid.session import checkpointed

#: Newton steps end when no zone's largest change is above this, or after so many.
TOLERANCE, MOST_STEPS = 1e-8, 100
K = len(CLASSES)


def scaled_rows(train: DataFrame, features: list[str], label: str, zone: str) -> tuple[DataFrame, DataFrame]:
    """(zone, x, y): features scaled by their zone's own means and population deviations, a 1 for the intercept in front; and
    those (zone, mean, std, n), one row per zone. A feature without spread is 0."""
    aggs = [f(F.col(c).cast("double")) for c in features for f in (F.avg, F.stddev_pop)]
    moments = train.groupBy(zone).agg(
        F.count(F.lit(1)).alias("n"), F.array(*aggs[0::2]).alias("mean"), F.array(*aggs[1::2]).alias("std")
    )
    moments = checkpointed(moments)
    return checkpointed(scale(train.join(moments, zone), features).select(zone, "x", F.col(label).cast("int").alias("y"))), moments


def scale(rows: DataFrame, features: list[str]) -> DataFrame:
    """``x`` from the features and their zone's ``mean`` and ``std``."""
    z = [
        F.when(F.col("std")[i] > 1e-12, (F.col(c).cast("double") - F.col("mean")[i]) / F.col("std")[i]).otherwise(F.lit(0.0)) for i, c in enumerate(features)
    ]
    return rows.withColumn("x", F.array(F.lit(1.0), *z))


def _softmax(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Probabilities of the classes; ``w`` is (rows, classes, columns)."""
    m = np.einsum("nf,nkf->nk", x, w)
    e = np.exp(m - m.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of one zone's summed log loss over some rows, flat: K * d, then (K * d) squared."""
    d = x.shape[1]
    p = _softmax(x, np.broadcast_to(w, (len(x), K, d)))
    gradient = (p - (y[:, None] == np.arange(K))).T @ x
    spread = np.einsum("nk,kl->nkl", p, np.eye(K)) - p[:, :, None] * p[:, None, :]
    hessian = np.einsum("nkl,nf,ng->kflg", spread, x, x, optimize=True)
    return np.concatenate([gradient.ravel(), hessian.ravel()])


def _partial(zone: str, d: int):
    """Per batch and zone the summed statistics, packed: a combine step in the task, so a hot zone shuffles a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zones = np.asarray(batch.column(0))
            x = np.asarray(batch.column(1).flatten()).reshape(len(zones), d)
            w = np.asarray(batch.column(3).flatten()).reshape(len(zones), K, d)
            y = np.asarray(batch.column(2))
            found = np.unique(zones)
            packed = [_sums(x[zones == z], y[zones == z], w[zones == z][0]).tobytes() for z in found]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(packed, pa.binary())], [zone, "sums"])

    return run


def fit_zones(train: DataFrame, features: list[str], label: str = "demand_class", zone: str = "pickup_location_id", c: float = 1.0) -> DataFrame:
    """(zone, n, mean, std, weights, steps) of one multinomial logistic model per zone; ``weights`` has K x (1 + features)
    numbers, intercepts first. Each minimises the zone's log loss plus 1 / (2 c) of its squared weights (no intercepts).

    One step is one pass over all rows: tasks sum gradients and Hessians by zone for each batch, Spark adds those up by zone, and the small systems
    are solved by zone, wherever their sums are. A zone's rows therefore never meet in one task, however many
    they are; per zone and batch a few kB are shuffled. Zones whose weights have settled drop out. No step moves a weight by more
    than 4. A class that a zone lacks gets a low intercept only. Rows with nulls are left out.
    """
    known = train.na.drop(subset=[*features, label])
    rows, moments = scaled_rows(known, features, label, zone)
    d = 1 + len(features)
    kind = moments.schema[zone].dataType.simpleString()
    state = checkpointed(moments.select(zone, F.array_repeat(F.lit(0.0), K * d).alias("weights"), F.lit(0).alias("steps"), F.lit(False).alias("settled")))
    ridge = np.concatenate([[1e-6], np.full(d - 1, 1.0 / c)])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b) for b in group["sums"]], axis=0)
        w = np.asarray(group["weights"].iloc[0], np.float64)
        penalty = np.tile(ridge, K)
        gradient = total[: K * d] + penalty * w
        hessian = total[K * d :].reshape(K * d, K * d) + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        largest = np.abs(move).max()
        move *= min(1.0, 4.0 / largest) if largest > 0 else 1.0
        return pd.DataFrame({zone: [group[zone].iloc[0]], "weights": [(w - move).tolist()], "steps": [int(group["steps"].iloc[0]) + 1], "settled": [bool(largest < TOLERANCE)]})

    schema = f"{zone} {kind}, weights array<double>, steps int, settled boolean"
    for _ in range(MOST_STEPS):
        open_ = state.filter(~F.col("settled"))
        sums = rows.join(open_.select(zone, "weights"), zone).select(zone, "x", "y", "weights").mapInArrow(_partial(zone, d), f"{zone} {kind}, sums binary")
        solved = sums.join(open_, zone).groupBy(zone).applyInPandas(solve, schema)
        state = checkpointed(solved.unionByName(state.filter("settled")))
        if state.filter(~F.col("settled")).isEmpty():
            break
    return moments.join(state, zone).select(zone, "n", "mean", "std", "weights", "steps")


def zone_probabilities(rows: DataFrame, models: DataFrame, features: list[str], names: list[str], zone: str = "pickup_location_id") -> DataFrame:
    """``rows`` with the class probabilities of their zone's model; zones without a model have none."""
    columns = rows.columns
    scored = scale(rows.join(models.select(zone, "mean", "std", "weights"), zone, "left"), features)
    d = 1 + len(features)

    def margin(k: int) -> Column:
        part = F.slice("weights", k * d + 1, d)
        return F.aggregate(F.zip_with("x", part, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    margins = scored.withColumns({f"_m{k}": margin(k) for k in range(K)})
    top = F.greatest(*(F.col(f"_m{k}") for k in range(K)))
    powers = [F.exp(F.col(f"_m{k}") - top) for k in range(K)]
    return margins.select(*columns, *((powers[k] / (powers[0] + powers[1] + powers[2])).alias(n) for k, n in enumerate(names)))
