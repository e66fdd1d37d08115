"""Boosting, forests and the parameter search against brute force and against their distributed form."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.ml import boosting, forest, search, trees

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    """600 rows of three classes that follow two features, as a binned frame in several blocks."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=600), rng.integers(0, 9, 600), rng.normal(size=600), rng.integers(0, 2, 600)])
    label = np.digitize(x[:, 0] + (x[:, 1] > 4) + 0.3 * rng.normal(size=600), [-0.2, 0.9])
    frame = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, label)], ", ".join(f"{f} double" for f in FEATURES) + ", label int").repartition(5, "a")
    binned = trees.binned_frame(trees.checkpointed(frame), FEATURES, "label", (0, 1, 2), np.bincount(label).tolist())
    assert binned.blocks.count() > 3
    return binned


def whole(data):
    parts = [trees.unpack(r.asDict(), data.features) for r in data.blocks.collect()]
    return [np.concatenate([p[i] for p in parts]) for i in range(3)]


def test_bins_follow_the_cuts(data):
    bins, _, _ = whole(data)
    starts = data.layout.starts
    assert [len(c) for c in data.layout.cuts][1] == 8 and len(data.layout.cuts[3]) == 1
    assert all(((bins[:, f] >= starts[f]) & (bins[:, f] < starts[f + 1])).all() for f in range(4))


def brute_split(bins, g, h, layout, allowed, least):
    """The best split of all rows, cut by cut."""
    best = None
    starts = layout.starts
    for f in range(bins.shape[1]):
        for b in range(starts[f], starts[f + 1] - 1) if allowed[f] else ():
            left = bins[:, f] <= b
            if min(left.sum(), (~left).sum()) < least or min(h[left].sum(), h[~left].sum()) < boosting.LEAST_HESSIAN * trees.SCALE:
                continue
            gain = (g[left].sum() ** 2 / h[left].sum() + g[~left].sum() ** 2 / h[~left].sum() - g.sum() ** 2 / h.sum()) / trees.SCALE
            if gain > (best[0] if best else boosting.LEAST_GAIN):
                best = (gain, f, b, (int(g[left].sum()), int(h[left].sum()), int(left.sum())))
    return best


def test_split_search_is_exhaustive(data):
    bins, labels, _ = whole(data)
    rng = np.random.default_rng(1)
    for least in (1, 20, 150):
        slots = rng.integers(-1, 6, len(bins))
        g, h = np.rint(rng.normal(size=len(bins)) * 1e6), np.rint(rng.uniform(0, 1, len(bins)) * 1e6)
        allowed = rng.random((6, 4)) < 0.7
        dense = trees.histograms(bins, slots, 6, int(data.layout.starts[-1]), [g, h, np.ones(len(bins))])
        many, _ = boosting.best_splits(*dense, data.layout, allowed, np.full(6, least))
        order = np.argsort(bins, axis=0, kind="stable").T
        same, _ = boosting.sorted_splits(bins, order, slots, 6, g, h, data.layout, allowed, least)
        assert many == same
        for s in range(6):
            at = slots == s
            want = brute_split(bins[at], g[at], h[at], data.layout, allowed[s], least)
            got = many[s]
            assert (want is None) == (got is None)
            if want:
                assert (got.feature, got.flat, got.left) == want[1:] and got.gain == pytest.approx(want[0])


def best_first(bins, g, h, layout, settings):
    """Leaves of the plain algorithm: the leaf of most gain is split until there are enough."""
    least = settings.least_rows
    leaves = [(np.ones(len(bins), bool), 0)]
    while len(leaves) < settings.leaves:
        options = []
        for i, (at, depth) in enumerate(leaves):
            found = brute_split(bins[at], g[at], h[at], layout, [True] * bins.shape[1], least) if settings.depth < 0 or depth < settings.depth else None
            if found:
                options.append((found[0], -i, found, at, depth))
        if not options:
            break
        _, i, (_, f, b, _), at, depth = max(options)
        left = at & (bins[:, f] <= b)
        leaves[-i : -i + 1] = [(left, depth + 1), (at & ~left, depth + 1)]
    return {tuple(np.flatnonzero(at)) for at, _ in leaves}


@pytest.mark.parametrize("params", [{"num_leaves": 6}, {"num_leaves": 40, "max_depth": 3}, {"num_leaves": 9, "min_child_samples": 40}])
def test_trees_grow_best_gain_first(data, params):
    bins, labels, ids = whole(data)
    settings = boosting.Settings.of({"n_estimators": 1, **params}, 42)
    g, h = boosting.gradients(np.zeros((3, len(bins))), labels, np.ones(3), np.ones(len(bins), bool))
    growth, where = boosting.Growth(settings), np.zeros(len(bins), np.int64)
    while nodes := growth.wanted():
        where = growth.nodes.route(bins, where)
        slots = np.full(len(growth.nodes.left), -1)
        slots[nodes] = np.arange(len(nodes))
        found = trees.histograms(bins, slots[where], len(nodes), int(data.layout.starts[-1]), [g[0], h[0], np.ones(len(bins))])
        splits, sums = boosting.best_splits(*found, data.layout, np.ones((len(nodes), 4), bool), np.full(len(nodes), settings.least_rows))
        for node, split, s in zip(nodes, splits, sums):
            growth.told(node, split, s)
    tree, step = growth.finished()
    leaf = tree.route(bins, np.zeros(len(bins), np.int64))
    assert {tuple(np.flatnonzero(leaf == i)) for i in np.unique(leaf)} == best_first(bins, g[0], h[0], data.layout, settings)
    for i in np.unique(leaf):
        at = leaf == i
        assert step[i] == pytest.approx(-settings.learning_rate * g[0][at].sum() / h[0][at].sum())


def same_model(a, b):
    for name, value in vars(a).items():
        np.testing.assert_array_equal(value, getattr(b, name), err_msg=name)


def test_distributed_boosting_gives_the_local_trees(data):
    trials = [
        boosting.Settings.of({"n_estimators": 2, "num_leaves": 4, "min_child_samples": 30}, 42),
        boosting.Settings.of({"n_estimators": 1, "num_leaves": 4, "max_depth": 2, "subsample": 0.7, "subsample_freq": 1, "colsample_bytree": 0.6, "class_weight": "balanced"}, 42),
    ]
    local = boosting.fit_trees(data, trials)
    spread = boosting.boost_table(data.blocks, data.features, data.counts, data.layout, trials)
    for a, b in zip(local, spread, strict=True):
        same_model(a, b)
    assert (local[0].probabilities(np.zeros((2, 4))).sum(1) - 1 < 1e-12).all()


def test_distributed_forest_gives_the_local_trees(data):
    trials = [forest.Settings.of({"n_estimators": 2, "max_depth": 5}, 42), forest.Settings.of({"n_estimators": 1, "max_depth": 3, "min_samples_leaf": 9, "class_weight": "balanced"}, 42)]
    local = forest.fit_trees(data, trials)
    spread = forest.collected(forest.node_table(data.blocks, data.features, data.counts, trials), data.counts, data.layout, trials)
    x = np.random.default_rng(2).normal(size=(500, 4)) * [1, 5, 1, 1]
    for a, b in zip(local, spread, strict=True):
        assert len(a.feature) == len(b.feature)
        np.testing.assert_allclose(a.probabilities(x), b.probabilities(x))


def test_forest_splits_are_exhaustive(data):
    bins, labels, ids = whole(data)
    rng = np.random.default_rng(8)
    slots, weight = rng.integers(-1, 5, len(bins)), rng.integers(1, 4, len(bins)).astype(float)
    hashes = rng.integers(0, 1 << 63, 5).astype(np.uint64)
    found = forest.sorted_splits(bins, slots, hashes, weight, labels, 3, 4, 42)
    turns = forest.orders(hashes, 4, 42)

    def gini(at):
        w = np.bincount(labels[at], weight[at], 3)
        return w.sum() - (w**2).sum() / w.sum()

    for s in range(5):
        at, looked = slots == s, turns[s][: forest.looked_at(4)]
        options = {}
        for f in looked:
            for b in np.unique(bins[at, f])[:-1]:
                left, right = at & (bins[:, f] <= b), at & (bins[:, f] > b)
                if min(left.sum(), right.sum()) >= 4:
                    options[(int(f), int(b))] = gini(left) + gini(right)
        assert options[found[s]] == pytest.approx(min(options.values()))


def test_forest_goes_deeper_than_thirty(spark):
    n = 72
    frame = spark.createDataFrame([(float(2**i), i % 2) for i in range(n)] * 3, "a double, label int")
    binned = trees.binned_frame(trees.checkpointed(frame.coalesce(1)), ["a"], "label", (0, 1), [3 * n // 2] * 2)
    [model] = forest.fit_trees(binned, [forest.Settings.of({"n_estimators": 15}, 42)])
    said = model.probabilities(np.array([[float(2**i)] for i in range(n)])).argmax(1)
    assert (said == np.arange(n) % 2).mean() > 0.97
    tree, _ = forest._grown(*whole(binned), binned.counts, forest.Settings.of({}, 42), [0])[0]
    assert sum(kid >= 0 for kid in tree.left) > 30


def test_model_survives_a_round_trip(spark, data, tmp_path):
    [model] = boosting.fit_trees(data, [boosting.Settings.of({"n_estimators": 2}, 42)])
    model.save(spark, str(tmp_path / "m"))
    same_model(model, trees.TreeModel.load(spark, str(tmp_path / "m")))


SPACE = {"x": ("uniform", -5.0, 5.0), "rate": ("log", 1e-3, 10.0), "n": ("int", 0, 40, 2), "kind": ("choice", ["a", "b", "c"])}


def bowl(p):
    return (p["x"] - 2) ** 2 + math.log(p["rate"] / 0.1) ** 2 + ((p["n"] - 12) / 8) ** 2 + (0 if p["kind"] == "b" else 4)


def test_search_beats_random_draws():
    def best(startup, seed):
        return min(loss for _, loss in search.minimise(SPACE, lambda b: [bowl(p) for p in b], 60, seed, startup=startup))

    guided, blind = ([best(s, seed) for seed in range(12)] for s in (10, 60))
    assert np.median(guided) < 0.5 * np.median(blind)


def test_search_is_seeded_and_stays_in_the_space():
    batches = []

    def losses(batch):
        batches.append(len(batch))
        return [bowl(p) for p in batch]

    a, b = search.minimise(SPACE, losses, 23, 1), search.minimise(SPACE, losses, 23, 1)
    assert a == b and batches == [10, 5, 5, 3] * 2
    for p, _ in a:
        assert -5 <= p["x"] <= 5 and 1e-3 <= p["rate"] <= 10 and p["n"] in range(0, 41, 2) and p["kind"] in "abc"


def test_densities_integrate_to_one():
    rng = random.Random(2)
    axis = search._Axis.of(("int", 0, 40, 2))
    density = search._Parzen(axis, [0, 4, 4, 40])
    assert sum(math.exp(density.log_density(v)) for v in range(0, 41, 2)) == pytest.approx(1)
    assert {density.sample(rng) for _ in range(500)} <= set(range(0, 41, 2))
    smooth = search._Parzen(search._Axis.of(("uniform", 0.0, 1.0)), [0.2, 0.9])
    assert sum(math.exp(smooth.log_density((i + 0.5) / 2000)) for i in range(2000)) / 2000 == pytest.approx(1, abs=1e-3)
