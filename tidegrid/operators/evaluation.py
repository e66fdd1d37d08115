"""Penalties, classification scores, cumulative cost and settlement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.cost import CLASSES, demand_class, over_share, penalty, under_share


def penalty_summary(pred: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    cost = penalty(F.col(actual), F.col(predicted))
    return pred.groupBy(*(by or [])).agg(
        F.avg(cost).alias("mean_penalty"), F.sum(cost).alias("total_penalty"), F.count(cost).alias("n")
    )


def confusion_cells(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    """All nine (actual, predicted) cells, absent ones as 0. Three counters per class, one pass."""
    counted = pred.agg(
        *[
            F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c{a}{p}")
            for a in CLASSES
            for p in CLASSES
        ]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("actual_class"), F.lit(p).alias("predicted_class"), F.col(f"c{a}{p}").alias("n")
            )
            for a in CLASSES
            for p in CLASSES
        ]
    )
    return counted.select(F.explode(cells).alias("c")).select("c.*")


def classification_scores(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: accuracy, macro precision / recall / F1 over the classes seen, mean and total penalty.

    Everything is derived from the nine confusion counts; an undefined ratio counts as 0.
    """
    cells = confusion_cells(pred, actual, predicted)
    n, a, p = F.col("n"), F.col("actual_class"), F.col("predicted_class")
    per_class = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("class"),
                    F.when((a == c) & (p == c), n).otherwise(0).alias("hit"),
                    F.when(a == c, n).otherwise(0).alias("real"),
                    F.when(p == c, n).otherwise(0).alias("said"),
                )
                for c in CLASSES
            ]
        )
    )

    def ratio(x: Column, y: Column) -> Column:
        return F.coalesce(F.try_divide(x, y), F.lit(0.0))

    classes = (
        cells.select(per_class.alias("k"))
        .groupBy("k.class")
        .agg(F.sum("k.hit").alias("hit"), F.sum("k.real").alias("real"), F.sum("k.said").alias("said"))
        .filter("real + said > 0")
        .select(
            ratio(F.col("hit"), F.col("said")).alias("precision"),
            ratio(F.col("hit"), F.col("real")).alias("recall"),
            ratio(2 * F.col("hit"), F.col("real") + F.col("said")).alias("f1"),
        )
        .agg(
            F.avg("precision").alias("precision_macro"),
            F.avg("recall").alias("recall_macro"),
            F.avg("f1").alias("macro_f1"),
        )
    )
    overall = cells.agg(
        F.try_divide(F.sum(F.when(a == p, n).otherwise(0)), F.sum(n)).alias("accuracy"),
        F.try_divide(F.sum(penalty(a, p) * n), F.sum(n)).alias("mean_penalty"),
        F.sum(penalty(a, p) * n).alias("total_penalty"),
        F.sum(n).alias("n"),
    )
    return overall.crossJoin(F.broadcast(classes))  # one row each


def signed_costs(pred: DataFrame) -> DataFrame:
    """Missed-revenue (positive) and wasted-resource (negative) bars of each row."""
    actual, said, cost = F.col("actual_class"), F.col("predicted_class"), F.col("model_penalty")
    return pred.withColumns(
        {
            "underprediction_penalty": under_share(actual, said, cost),
            "overprediction_penalty": over_share(actual, said, cost),
        }
    )


def settled_rows(pred: DataFrame) -> DataFrame:
    return pred.filter(F.col("model_penalty").isNotNull() & F.col("baseline_penalty").isNotNull())


def cumulative_costs(pred: DataFrame, zone: str = "pickup_location_id", ts: str = "prediction_hour_ts") -> DataFrame:
    """Running model and baseline cost per zone in hour order, over settled rows."""
    w = Window.partitionBy(zone).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return settled_rows(pred).withColumns(
        {
            "model_cumulative": F.sum("model_penalty").over(w),
            "baseline_cumulative": F.sum("baseline_penalty").over(w),
        }
    )


def net_savings(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total costs, savings against the baseline, their percentage and a verdict, per group or overall."""
    return with_savings(pred.groupBy(*(by or [])).agg(*(total.alias(name) for name, total in cost_totals().items())))


def cost_totals() -> dict[str, Column]:
    """Settled rows and total costs, as aggregates that also serve as window functions."""
    both = F.col("model_penalty").isNotNull() & F.col("baseline_penalty").isNotNull()
    return {
        "settled": F.count(F.when(both, F.lit(1))),
        "model_cost": F.sum(F.when(both, F.col("model_penalty")).otherwise(F.lit(0.0))),
        "baseline_cost": F.sum(F.when(both, F.col("baseline_penalty")).otherwise(F.lit(0.0))),
    }


def with_savings(totals: DataFrame) -> DataFrame:
    """Savings, their percentage and the verdict next to total costs (null: none)."""
    totals = totals.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("model_cost", "baseline_cost")})
    model, base = F.col("model_cost"), F.col("baseline_cost")
    percent = F.col("savings_percent")
    verdict = (
        F.when(F.col("settled") == 0, "awaiting_settlement")
        .when(percent > 0, "reduced")
        .when(percent < 0, "increased")
        .when(base > 0, "matched")
        .when(model == 0, "no_cost")
        .otherwise("cost_without_baseline")
    )
    return totals.withColumns(
        {
            "net_savings": base - model,
            "savings_percent": F.when(base > 0, F.try_divide(base - model, base) * 100),
        }
    ).withColumn("verdict", verdict)


def pending_rows(pred: DataFrame, now: Column) -> DataFrame:
    """Predictions whose hour has arrived but which have no actual yet."""
    return pred.filter(F.col("actual_class").isNull() & (F.col("prediction_hour_ts") <= now))


def settle_rows(pending: DataFrame, observations: DataFrame) -> DataFrame:
    """Pending predictions that have an observed count, with class and penalties filled in.

    One equi-join for all rows. The month columns of the observation table are part of the join
    condition so that only the months of pending hours are read.
    """
    seen = observations.select(
        "pickup_location_id",
        F.col("pickup_hour_ts").alias("prediction_hour_ts"),
        F.col("ride_count").alias("_seen"),
        *[c for c in ("target_year", "target_month") if c in observations.columns],
    ).filter(F.col("_seen").isNotNull())
    keys = ["pickup_location_id", "prediction_hour_ts"]
    columns = pending.columns
    if {"target_year", "target_month"} <= set(seen.columns):
        keys += ["target_year", "target_month"]
        hour = F.col("prediction_hour_ts")
        pending = pending.withColumns({"target_year": F.year(hour), "target_month": F.month(hour)})
    actual = demand_class(F.col("_seen"), F.col("threshold_q25"), F.col("threshold_q75"))
    return (
        pending.join(seen, keys)
        .withColumns({"actual_class": actual, "actual_ride_count": F.col("_seen").cast("int")})
        .withColumns(
            {
                "model_penalty": penalty(F.col("actual_class"), F.col("predicted_class")),
                "baseline_penalty": penalty(F.col("actual_class"), F.col("baseline_predicted_class")),
            }
        )
        .select(*columns)
    )


def unsettled_rows(pending: DataFrame, observations: DataFrame) -> DataFrame:
    """Due predictions whose hour has no observed count yet."""
    seen = observations.filter(F.col("ride_count").isNotNull()).select(
        "pickup_location_id", F.col("pickup_hour_ts").alias("prediction_hour_ts")
    )
    return pending.join(seen, ["pickup_location_id", "prediction_hour_ts"], "left_anti")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_class): one row per class seen."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_class"))
    totals = counts.agg(F.sum("n_class").alias("n"), F.count("*").alias("k"))
    return counts.crossJoin(F.broadcast(totals)).select(
        label, "n_class", (F.col("n") / (F.col("k") * F.col("n_class"))).alias("weight")
    )
