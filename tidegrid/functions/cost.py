"""Demand classes and the asymmetric cost of getting them wrong."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.schemas import CLASS_LABELS, OVER_COST, UNDER_COST

CLASSES = tuple(CLASS_LABELS)


def demand_class(count: Column, q25: Column, q75: Column) -> Column:
    """0 below q25, 1 up to and including q75, 2 above; unknown stays unknown."""
    known = count.isNotNull() & q25.isNotNull() & q75.isNotNull()
    graded = F.when(count < q25, 0).when(count <= q75, 1).otherwise(2)
    return F.when(known, graded).cast("int")


def penalty(actual: Column, predicted: Column) -> Column:
    """Cost of one settled prediction; null while either side is unknown."""
    gap = (actual - predicted).cast("double")
    return F.when(gap >= 0, gap * UNDER_COST).when(gap < 0, -gap * OVER_COST)


def expected_cost(probabilities: list[Column], choice: int) -> Column:
    """Expected penalty of announcing ``choice`` under the class probabilities."""
    total = F.lit(0.0)
    for actual in CLASSES:
        gap = actual - choice
        weight = gap * UNDER_COST if gap > 0 else -gap * OVER_COST
        if weight:
            total = total + F.coalesce(probabilities[actual], F.lit(0.0)) * F.lit(weight)
    return total


def cheapest_class(probabilities: list[Column]) -> Column:
    """The class with the least expected cost; the lower class wins a tie."""
    costs = F.array(*[expected_cost(probabilities, c) for c in CLASSES])
    return (F.array_position(costs, F.array_min(costs)) - 1).cast("int")


def under_share(actual: Column, predicted: Column, cost: Column) -> Column:
    """Positive bar: cost of predicting too low, 0 when unsettled."""
    return F.when((actual > predicted) & cost.isNotNull(), cost).otherwise(F.lit(0.0))


def over_share(actual: Column, predicted: Column, cost: Column) -> Column:
    """Negative bar: cost of predicting too high, 0 when unsettled."""
    return F.when((predicted > actual) & cost.isNotNull(), -cost).otherwise(F.lit(0.0))


def confidence(predicted: Column, probabilities: list[Column]) -> Column:
    """Probability of the announced class; null when the class is unknown."""
    return F.try_element_at(F.array(*probabilities), (predicted + 1).cast("int"))
