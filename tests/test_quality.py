import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.operators import quality
from tidegrid.operators import quantile
from tidegrid.operators.quantile import discrete_quantiles, interpolated_quantiles

CAPS = quality.Caps(100.0, 20.0)
GOOD = dict(
    tpep_pickup_datetime=dt.datetime(2024, 1, 10, 12), tpep_dropoff_datetime=dt.datetime(2024, 1, 10, 12, 10),
    PULocationID=2, DOLocationID=5, total_amount=10.0, trip_distance=2.0, passenger_count=1.0,
)
T0 = dt.datetime(2024, 1, 10, 12)
CASES = [
    ({}, True),
    ({"total_amount": 2.99}, False), ({"total_amount": 3.0}, True), ({"total_amount": 100.0}, True),
    ({"total_amount": 100.01}, False),
    ({"trip_distance": 0.0}, False), ({"trip_distance": 0.01}, True), ({"trip_distance": 20.0}, True),
    *[({"passenger_count": p}, ok) for p, ok in ((None, False), (0.0, False), (1.0, True), (5.0, True), (6.0, False))],
    *[({"PULocationID": z}, ok) for z, ok in ((1, False), (264, False), (265, False), (2, True), (263, True))],
    ({"tpep_dropoff_datetime": T0 + dt.timedelta(milliseconds=400)}, False),
    ({"tpep_dropoff_datetime": T0 + dt.timedelta(seconds=1)}, True),
    ({"tpep_pickup_datetime": dt.datetime(2024, 1, 1)}, True),
    ({"tpep_pickup_datetime": dt.datetime(2024, 2, 1), "tpep_dropoff_datetime": dt.datetime(2024, 2, 2)}, False),
    *[({c: None}, False) for c in GOOD],
]
SCHEMA = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, DOLocationID int, "
    "total_amount double, trip_distance double, passenger_count double, expected boolean"
)


def test_validity_edge_rows(spark):
    rows = [tuple({**GOOD, **change}.values()) + (ok,) for change, ok in CASES]
    frame = spark.createDataFrame(rows, SCHEMA)
    judged = quality.with_reasons(frame, 2024, 1, CAPS)
    assert judged.filter("is_valid is null").isEmpty()
    assert judged.filter("is_valid <> expected").collect() == []


def test_gate_limit():
    assert quality.gate_open(35.0)
    assert not quality.gate_open(35.01)


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(quality.QualityError):
        quality.outlier_caps(empty)
    assert quality.drop_rate(empty, F.lit(True)).first()["dropped_percent"] == 0.0


def test_contracts(spark):
    frame = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, fare_amount double")
    with pytest.raises(quality.QualityError):
        quality.forbid_leakage(frame)
    with pytest.raises(quality.QualityError):
        quality.require_columns(frame, ["k", "absent"])
    with pytest.raises(quality.QualityError):
        quality.require_unique(frame, ["k"])
    assert quality.require_columns(frame, ["fare_amount", "k"]).columns == ["fare_amount", "k"]


def _disc(values, p):
    ordered = sorted(values)
    return ordered[max(1, int(np.ceil(p * len(ordered)))) - 1]


def test_quantiles_of_awkward_columns(spark):
    rng = random.Random(5)
    heavy = [7.0] * 3000 + [rng.choice([1.0, 2.5, 9.0]) for _ in range(1500)]
    wild = [rng.lognormvariate(0, 4) for _ in range(4400)] + [1e15] * 50 + [-1e12] * 50
    rows = list(zip(heavy, wild, [None] * 4500)) + [(None, float("nan"), None)] * 20
    frame = spark.createDataFrame(rows, "heavy double, wild double, none double").repartition(7)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = discrete_quantiles(frame, {"heavy": probs, "wild": probs, "none": probs})
    assert found["heavy"] == [_disc(heavy, p) for p in probs]
    assert found["wild"] == [_disc(wild, p) for p in probs]
    assert found["none"] == [None] * len(probs)
    smooth = interpolated_quantiles(frame, {"wild": probs})["wild"]
    assert smooth == pytest.approx(list(np.quantile(wild, probs)), rel=1e-12)


@pytest.mark.parametrize("values", [
    [float("inf")] + [float(i) for i in range(600)], [float("-inf")] * 3 + [1.0, 2.0] + [float("inf")] * 3, [float("inf")] * 4,
    [-1.7e308, 1.7e308, 0.0, 5e-324, float("nan"), float("inf")], [5e-324, 1e-323, 1.5e-323],
])
def test_quantiles_end_on_extreme_values(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.9, 0.999, 1.0]
    kept = sorted(v for v in values if v == v)
    assert discrete_quantiles(frame, {"x": probs})["x"] == [_disc(kept, p) for p in probs]


def test_quantiles_survive_a_wrong_bracket(spark, monkeypatch):
    frame = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    original = quantile._bracket

    def misleading(df, wanted):
        return {c: (n, lo, hi, [hi, hi] * len(wanted[c])) for c, (n, lo, hi, _) in original(df, wanted).items()}

    monkeypatch.setattr(quantile, "_bracket", misleading)
    assert discrete_quantiles(frame, {"x": [0.25, 0.9]})["x"] == [250.0, 900.0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.floats(0, 1))
def test_quantile_property(spark, values, p):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert discrete_quantiles(frame, {"x": [p]})["x"] == [_disc(values, p)]
