"""Models of all zones at once against a plain fit of each zone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.ml import zones

NAMES = ["p0", "p1", "p2"]


def plain_fit(x, y, c=1.0):
    """Gradient descent on the same objective over one zone, from rows scaled in numpy."""
    std = x.std(0)
    z = np.column_stack([np.ones(len(x)), np.where(std > 1e-12, (x - x.mean(0)) / np.where(std > 1e-12, std, 1), 0)])
    ridge, w = np.concatenate([[1e-6], np.full(x.shape[1], 1 / c)]), np.zeros((3, z.shape[1]))
    hot = (y[:, None] == np.arange(3)).astype(float)
    rate = 1.0 / (0.5 * np.linalg.norm(z, 2) ** 2 + 1 / c)
    past = w
    for t in range(20000):
        ahead = w + t / (t + 3) * (w - past)
        m = z @ ahead.T
        e = np.exp(m - m.max(1, keepdims=True))
        past, w = w, ahead - rate * ((e / e.sum(1, keepdims=True) - hot).T @ z + ridge * ahead)
    m = z @ w.T
    e = np.exp(m - m.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def test_every_zone_is_fitted_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = []
    for zone, n in ((1, 900), (2, 60), (3, 40)):  # one zone has 90 % of the rows
        x = rng.normal(size=(n, 3))
        x[:, 2] = 7.0 if zone == 2 else x[:, 2]  # a feature without spread
        y = np.digitize(x[:, 0] * (1 if zone < 3 else -1) + rng.normal(size=n), [-0.5, 0.5])
        y = np.minimum(y, 1) if zone == 3 else y  # a class that the zone lacks
        rows += [(zone, *map(float, r), int(c)) for r, c in zip(x, y)]
    frame = spark.createDataFrame([*rows, (1, None, 0.0, 0.0, 1)], "pickup_location_id int, a double, b double, c double, demand_class int").repartition(6)
    fitted = zones.fit_zones(frame, ["a", "b", "c"])
    assert {r["pickup_location_id"]: r["n"] for r in fitted.collect()} == {1: 900, 2: 60, 3: 40}
    scored = zones.zone_probabilities(frame.na.drop(), fitted, ["a", "b", "c"], NAMES).collect()
    for zone in (1, 2, 3):
        mine = [r for r in rows if r[0] == zone]
        want = plain_fit(np.array([r[1:4] for r in mine]), np.array([r[4] for r in mine]))
        got = {(r["a"], r["b"]): [r[p] for p in NAMES] for r in scored if r["pickup_location_id"] == zone}
        assert np.array([got[r[1:3]] for r in mine]) == pytest.approx(want, abs=2e-3)
    other = frame.na.drop().limit(1).withColumn("pickup_location_id", F.lit(99))
    assert zones.zone_probabilities(other, fitted, ["a", "b", "c"], NAMES).first()["p0"] is None
