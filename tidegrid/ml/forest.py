"""Random forests without a depth limit: all trees grow level by level, rows carry their node."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.ml.trees import LOCAL_ROWS, SCALE, BinnedFrame, Layout, TreeModel, TreeNodes, fit_locally, pack, uniform, unpack
from tidegrid.session import checkpointed

#: Cumulative Poisson(1) probabilities: how often a bootstrap sample takes a row.
_TIMES = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800)])
#: Rows x trees x features that one step of a local fit holds.
CELLS = 1 << 19


@dataclass(frozen=True)
class Settings:
    """What one trial asks for; the defaults are those of the library that the names are known from."""

    trees: int = 100
    depth: int | None = None
    least_rows: int = 1
    balanced: bool = False
    seed: int = 42

    @classmethod
    def of(cls, params: dict, seed: int) -> Settings:
        depth = params.get("max_depth")
        return cls(int(params.get("n_estimators", 100)), None if depth is None else int(depth), int(params.get("min_samples_leaf", 1)), params.get("class_weight") == "balanced", seed)


def bootstrap(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree's sample takes each row: Poisson(1) numbers from row id, seed and tree."""
    return np.searchsorted(_TIMES, uniform(ids, seed, tree), side="right").astype(np.float64)


def class_weights(counts: np.ndarray, balanced: bool) -> np.ndarray:
    return np.rint((counts.sum() / (len(counts) * counts) if balanced else np.ones(len(counts))) * SCALE)


def priorities(nodes: np.ndarray, features: int, seed: int) -> np.ndarray:
    """In which order nodes (by their hashes) look at features: (nodes x features) random numbers."""
    return np.stack([uniform(nodes, seed, 7919 + f) for f in range(features)], axis=1)


def child(node: np.ndarray, side: int) -> np.ndarray:
    """The hash that names a node's child: depends on the path from the root only, whatever the depth."""
    x = (node.astype(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93 + side)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def root(seed: int, tree: int) -> np.ndarray:
    return child(np.array([seed * 1_000_003 + tree], np.uint64), 2)


def looked_at(features: int) -> int:
    return max(1, int(np.sqrt(features)))


def orders(nodes: np.ndarray, features: int, seed: int) -> np.ndarray:
    """(nodes x features): the features in the order in which each node looks at them."""
    return np.argsort(priorities(nodes, features, seed), axis=1, kind="stable")


def _searched(bins: np.ndarray, slots: np.ndarray, turns: np.ndarray, weight: np.ndarray, labels: np.ndarray, k: int, least_rows: int) -> dict[int, tuple[int, int]]:
    """slot -> (feature, flat bin) of the cut that lowers Gini impurity most among the features in ``turns`` (slots x some), the
    first on ties. ``slots`` and ``weight`` are of rows, one tree after another (-1: none)."""
    held = np.flatnonzero(slots >= 0)
    if not len(held):
        return {}
    n, j, count = len(bins), turns.shape[1], len(turns)
    row, slot = held % n, slots[held]
    key = bins[row[:, None], turns[slot]].T + slot * (int(bins.max()) + 1)
    by_key = np.argsort(key, axis=1, kind="stable")
    slot = np.sort(slot)
    first = np.searchsorted(slot, np.arange(count + 1))
    present = np.flatnonzero(np.diff(first))
    size = np.diff(first)[present]
    here, label, w = np.take_along_axis(key, by_key, axis=1), labels[row][by_key], weight[held][by_key]
    score, right_score, left_w, all_w = (np.zeros((j, len(held))) for _ in range(4))
    for c in range(k):
        run = np.cumsum(np.where(label == c, w, 0.0), axis=1)
        ends = run[:, first[present + 1] - 1]
        base = np.concatenate([np.zeros((j, 1)), ends[:, :-1]], axis=1)
        left = run - np.repeat(base, size, axis=1)
        right = np.repeat(ends - base, size, axis=1) - left
        score += left * left
        right_score += right * right
        left_w += left
        all_w += left + right
    nl = np.arange(len(held)) - first[slot] + 1
    changes = np.zeros(here.shape, bool)
    changes[:, :-1] = here[:, 1:] != here[:, :-1]
    rows_fit = (np.arange(len(held)) + 1 < first[slot + 1]) & (nl >= least_rows) & (first[slot + 1] - first[slot] - nl >= least_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(changes & rows_fit & (left_w > 0) & (left_w < all_w), score / left_w + right_score / (all_w - left_w), -np.inf)
    top = np.maximum.reduceat(gain, first[present], axis=1)
    out = {}
    for i, s in enumerate(present):
        best = top[:, i].max()
        if np.isfinite(best):
            f, turn = min((int(turns[s, t]), t) for t in np.flatnonzero(top[:, i] == best))
            at = first[s] + int(np.argmax(gain[turn, first[s] : first[s + 1]]))
            out[int(s)] = (f, int(here[turn, at] % (int(bins.max()) + 1)))
    return out


def sorted_splits(
    bins: np.ndarray, slots: np.ndarray, hashes: np.ndarray, weight: np.ndarray, labels: np.ndarray, k: int, least_rows: int, seed: int
) -> dict[int, tuple[int, int]]:
    """Each slot's best cut among the features that it looks at first; if none of them can split it, that of the next one that can."""
    turns, look = orders(hashes, bins.shape[1], seed), looked_at(bins.shape[1])
    found = _searched(bins, slots, turns[:, :look], weight, labels, k, least_rows)
    at = look
    while len(found) < len(hashes) and at < bins.shape[1]:
        left = np.ones(len(hashes), bool)
        left[list(found)] = False
        found.update(_searched(bins, np.where((slots >= 0) & left[slots], slots, -1), turns[:, at : at + 1], weight, labels, k, least_rows))
        at += 1
    return found


def _grown(bins: np.ndarray, labels: np.ndarray, ids: np.ndarray, counts: np.ndarray, settings: Settings, numbers: list[int]) -> list[tuple[TreeNodes, np.ndarray]]:
    """Some trees of a trial, level by level side by side."""
    k, n = len(counts), len(labels)
    per_class = class_weights(counts, settings.balanced)
    taken = np.stack([bootstrap(ids, settings.seed, t) for t in numbers])
    weight = taken * per_class[labels]
    trees = [TreeNodes.root() for _ in numbers]
    names = [{0: root(settings.seed, t)[0]} for t in numbers]
    where = np.zeros((len(numbers), n), np.int64)
    mass = [np.zeros((1, k)) for _ in numbers]
    fresh = [[0] for _ in numbers]
    depth = 0
    while any(fresh):
        places, slots = [], np.full((len(numbers), n), -1)
        for t, tree in enumerate(trees):
            held = np.bincount(where[t] * k + labels, weight[t], len(tree.left) * k).reshape(-1, k)
            rows = np.bincount(where[t][taken[t] > 0], minlength=len(tree.left))
            grown = np.zeros((len(tree.left), k))
            grown[: len(mass[t])] = mass[t]
            grown[fresh[t]] = held[fresh[t]]
            mass[t] = grown
            if settings.depth is not None and depth >= settings.depth:
                continue
            open_ = [node for node in fresh[t] if rows[node] >= max(2, 2 * settings.least_rows) and (held[node] > 0).sum() > 1]
            slot_of = np.full(len(tree.left), -1)
            slot_of[open_] = len(places) + np.arange(len(open_))
            slots[t] = np.where(taken[t] > 0, slot_of[where[t]], -1)
            places += [(t, node) for node in open_]
        fresh = [[] for _ in numbers]
        if not places:
            break
        hashes = np.array([names[t][node] for t, node in places], np.uint64)
        for s, (f, flat) in sorted_splits(bins, slots.ravel(), hashes, weight.ravel(), labels, k, settings.least_rows, settings.seed).items():
            t, node = places[s]
            kids = trees[t].split(node, f, flat)
            fresh[t] += kids
            names[t].update({kid: child(hashes[s : s + 1], side)[0] for side, kid in enumerate(kids)})
        for t, tree in enumerate(trees):
            if fresh[t]:
                where[t] = tree.route(bins, where[t])
        depth += 1
    values = [m / np.maximum(m.sum(1, keepdims=True), 1e-300) for m in mass]
    return list(zip(trees, values))


def forest_local(bins: np.ndarray, labels: np.ndarray, ids: np.ndarray, counts: np.ndarray, layout: Layout, settings: Settings) -> TreeModel:
    """One trial on a frame that a task holds, a few trees at a time."""
    together = max(1, CELLS // max(1, bins.size))
    grown = []
    for at in range(0, settings.trees, together):
        grown += _grown(bins, labels, ids, counts, settings, list(range(at, min(settings.trees, at + together))))
    return pack(grown, layout, np.zeros(len(counts)), False)


def node_table(blocks: DataFrame, features: int, counts: np.ndarray, trials: list[Settings]) -> DataFrame:
    """(trial, tree, node, feature, flat, left, right, mass) of all trees of all trials on a frame that stays distributed.

    Rows carry the hash of their node in each tree. A level is one aggregate of class weights by (trial, tree, node, feature, bin),
    combined in the tasks; running sums within (node, feature) give the sides of every cut, the best one is joined
    back to the rows. Rows whose node has no split leave. The node table is as large as the trees are.
    """
    spark, k = blocks.sparkSession, len(counts)
    salt = [(i, t) for i, s in enumerate(trials) for t in range(s.trees)]
    per_class = [class_weights(counts, s.balanced) for s in trials]
    look = looked_at(features)

    def opened(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bins, labels, ids = unpack(row, features)
                for i, t in salt:
                    taken = bootstrap(ids, trials[i].seed, t)
                    at = np.flatnonzero(taken)
                    name = root(trials[i].seed, t).view(np.int64)[0]
                    yield pd.DataFrame(
                        {"trial": i, "tree": t, "node": name, "label": labels[at], "w": (taken * per_class[i][labels])[at].astype(np.int64), "bins": list(bins[at])}
                    )

    def frames(batches):
        import pyarrow as pa

        for frame in opened(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False, schema=pa.schema(
                [("trial", pa.int32()), ("tree", pa.int32()), ("node", pa.int64()), ("label", pa.int32()), ("w", pa.int64()), ("bins", pa.list_(pa.int32()))]))

    rows = checkpointed(blocks.select("bins", "labels", "ids").mapInArrow(frames, "trial int, tree int, node long, label int, w long, bins array<int>"))
    limits = spark.createDataFrame(
        [(i, s.depth if s.depth is not None else 1 << 30, s.least_rows, s.seed) for i, s in enumerate(trials)], "trial int, most_depth int, least_rows int, seed int"
    )
    key = ["trial", "tree", "node"]
    cells = [F.sum(F.when(F.col("label") == c, F.col("w")).otherwise(0)).alias(f"m{c}") for c in range(k)]
    mass = [f"m{c}" for c in range(k)]

    @F.pandas_udf("array<long>")
    def kids(node: pd.Series) -> pd.Series:
        x = node.to_numpy(np.int64).view(np.uint64)
        return pd.Series(list(np.stack([child(x, 0).view(np.int64), child(x, 1).view(np.int64)], axis=1)))

    @F.pandas_udf("array<int>")
    def turns(node: pd.Series, seed: pd.Series) -> pd.Series:
        x = node.to_numpy(np.int64).view(np.uint64)
        out = np.zeros((len(x), features), np.int32)
        for s in np.unique(seed):
            here = (seed == s).to_numpy()
            out[here] = np.argsort(orders(x[here], features, int(s)), axis=1)
        return pd.Series(list(out))

    done, depth = [], 0
    while True:
        nodes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), *cells)
        pure = F.size(F.filter(F.array(*mass), lambda m: m > 0)) < 2
        nodes = checkpointed(nodes.join(F.broadcast(limits), "trial"))  # one row per trial
        open_ = nodes.where((F.lit(depth) < F.col("most_depth")) & (F.col("rows") >= F.greatest(F.lit(2), 2 * F.col("least_rows"))) & ~pure)
        spread = rows.join(open_.select(*key), key, "left_semi").select(*key, "label", "w", F.posexplode("bins").alias("feature", "bin"))
        by_bin = spread.groupBy(*key, "feature", "bin").agg(F.count(F.lit(1)).alias("n"), *cells)
        run = Window.partitionBy(*key, "feature").orderBy("bin")
        totals = open_.select(*key, "rows", "least_rows", "seed", *[F.col(m).alias(f"all_{m}") for m in mass])
        sides = by_bin.select(*key, "feature", "bin", F.sum("n").over(run).alias("nl"), *[F.sum(m).over(run).cast("double").alias(m) for m in mass]).join(totals, key)
        wl, wa = sum(F.col(m) for m in mass), sum(F.col(f"all_{m}").cast("double") for m in mass)
        gain = sum(F.col(m) * F.col(m) for m in mass) / wl + sum((F.col(f"all_{m}") - F.col(m)) * (F.col(f"all_{m}") - F.col(m)) for m in mass) / (wa - wl)
        cuts = sides.where((F.col("nl") >= F.col("least_rows")) & (F.col("rows") - F.col("nl") >= F.col("least_rows")) & (wl > 0) & (wl < wa))
        by_feature = cuts.groupBy(*key, "feature").agg(F.max_by(F.struct("bin", gain.alias("gain")), F.struct(gain, -F.col("bin"))).alias("best"), F.first("seed").alias("seed"))
        ranked = by_feature.withColumn("turn", F.get(turns("node", "seed"), F.col("feature")))
        able = F.row_number().over(Window.partitionBy(*key).orderBy("turn"))
        seen = ranked.withColumn("able", able).where((F.col("turn") < look) | (F.col("able") == 1))
        splits = checkpointed(
            seen.groupBy(*key).agg(F.max_by(F.struct("feature", "best.bin"), F.struct("best.gain", -F.col("feature"))).alias("cut"))
            .select(*key, "cut.feature", "cut.bin", kids("node").alias("kids"))
        )
        done.append(
            nodes.join(splits, key, "left").select(
                *key, F.lit(depth).alias("depth"), "feature", F.col("bin").alias("flat"), F.col("kids")[0].alias("left"), F.col("kids")[1].alias("right"), F.array(*mass).alias("mass")
            )
        )
        if splits.isEmpty():
            break
        goes = F.when(F.get("bins", F.col("feature")) <= F.col("bin"), F.col("kids")[0]).otherwise(F.col("kids")[1])
        rows = checkpointed(rows.join(splits, key).select("trial", "tree", goes.alias("node"), "label", "w", "bins"))
        depth += 1
    table = done[0]
    for level in done[1:]:
        table = table.unionByName(level)
    return table


def collected(table: DataFrame, counts: np.ndarray, layout: Layout, trials: list[Settings]) -> list[TreeModel]:
    """Models from a node table, for scoring by tasks that hold a whole model; it has to fit there, so
    large frames need a depth or a least number of rows a leaf."""
    found = {(r["trial"], r["tree"], r["node"]): r for r in table.collect()}
    out = []
    for i, settings in enumerate(trials):
        grown = []
        for t in range(settings.trees):
            tree, values = TreeNodes.root(), {}
            stack = [(int(root(settings.seed, t).view(np.int64)[0]), 0)]
            while stack:
                name, at = stack.pop()
                row = found.get((i, t, name))
                mass = np.array(row["mass"], np.float64) if row is not None else np.ones(len(counts))
                values[at] = mass / max(mass.sum(), 1e-300)
                if row is not None and row["flat"] is not None:
                    stack += list(zip((row["left"], row["right"]), tree.split(at, row["feature"], row["flat"])))
            grown.append((tree, np.stack([values[n] for n in range(len(tree.left))])))
        out.append(pack(grown, layout, np.zeros(len(counts)), False))
    return out


def fit_trees(data: BinnedFrame, trials: list[Settings]) -> list[TreeModel]:
    """One forest per trial, over the classes seen."""
    if data.counts.sum() > LOCAL_ROWS:
        return collected(node_table(data.blocks, data.features, data.counts, trials), data.counts, data.layout, trials)
    return fit_locally(data, forest_local, trials)
