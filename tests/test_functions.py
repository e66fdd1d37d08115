import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import clock, cost, text
from tidegrid.schemas import UNDER_COST

MATRIX = [[0, 10, 20], [15, 0, 10], [30, 15, 0]]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_penalty_matrix(spark):
    pairs = [(a, p) for a in range(3) for p in range(3)] + [(None, 1), (1, None)]
    rows = spark.createDataFrame(pairs, "a int, p int").select("a", "p", cost.penalty(F.col("a"), F.col("p")).alias("c"))
    for r in rows.collect():
        expected = None if r["a"] is None or r["p"] is None else float(MATRIX[r["a"]][r["p"]])
        assert r["c"] == expected
        assert str(r["c"]) != "-0.0"
    assert UNDER_COST == 15.0


@pytest.mark.parametrize(
    "probs, expected",
    [((0.1, 0.2, 0.7), 2), ((0.0, 0.4, 0.6), 2), ((0.4, 0.6, 0.0), 1), ((0.0, 0.0, 0.0), 0), ((None, 0.4, 0.6), 2)],
)
def test_cost_sensitive_decision(spark, probs, expected):
    columns = [F.lit(p).cast("double") for p in probs]
    assert one(spark, cost.cheapest_class(columns)) == expected


def test_expected_costs(spark):
    columns = [F.lit(p) for p in (0.1, 0.2, 0.7)]
    assert [round(one(spark, cost.expected_cost(columns, c)), 9) for c in range(3)] == [24.0, 11.5, 4.0]


def test_demand_class_boundaries(spark):
    counts = [35.9, 36.0, 349.0, 349.1, None]
    frame = spark.createDataFrame([(c,) for c in counts], "n double")
    got = [r[0] for r in frame.select(cost.demand_class(F.col("n"), F.lit(36.0), F.lit(349.0))).collect()]
    assert got == [0, 1, 1, 2, None]


@pytest.mark.parametrize(
    "now, expected",
    [
        ("2026-07-12 17:45:00", dt.datetime(2026, 5, 12, 17)),
        ("2026-04-30 17:40:00", dt.datetime(2026, 2, 28, 17)),
    ],
)
def test_simulated_clock(spark, now, expected):
    shifted = clock.simulated_clock(clock.utc_literal(now), 2)
    assert one(spark, shifted.cast("timestamp_ntz")) == expected


def test_month_bounds():
    assert clock.month_bounds(2025, 12) == (dt.datetime(2025, 12, 1), dt.datetime(2026, 1, 1))
    for bad in ((1999, 1), (2101, 1), (2024, 0), (2024, 13)):
        with pytest.raises(ValueError):
            clock.month_bounds(*bad)


def test_weekday_starts_on_monday(spark):
    monday = clock.utc_literal("2024-01-01 00:00:00")
    assert one(spark, clock.day_of_week(monday)) == 0
    assert one(spark, clock.is_weekend(clock.add_hours(monday, 5 * 24))) == 1


def test_display_text(spark):
    assert one(spark, text.penalty_text(F.lit(1234.0))) == "1,234 Units"
    assert one(spark, text.penalty_text(F.lit(None).cast("double"))) == "Awaiting Settlement"
    assert one(spark, text.confidence_text(F.lit(0.913))) == "91.30%"
    assert one(spark, text.class_caption(F.lit(None).cast("int"))) == "Pending Ground Truth"
    assert one(spark, text.class_caption(F.lit(7))) == "7"
    assert one(spark, cost.confidence(F.lit(5), [F.lit(0.1)] * 3)) is None
