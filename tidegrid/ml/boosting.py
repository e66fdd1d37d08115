"""Gradient boosting of several classes at once: softmax gradients, binned histograms, trees grown best gain first."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.ml.trees import LOCAL_ROWS, SCALE, BinnedFrame, Layout, TreeModel, TreeNodes, fit_locally, histograms, pack, uniform, unpack
from tidegrid.session import checkpointed

LEAST_HESSIAN = 1e-3
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Settings:
    """What one trial asks for; the defaults are those of the gradient-boosting library that the names are known from."""

    rounds: int = 100
    learning_rate: float = 0.1
    leaves: int = 31
    depth: int = -1
    least_rows: int = 20
    row_share: float = 1.0
    row_every: int = 0
    column_share: float = 1.0
    balanced: bool = False
    seed: int = 42

    @classmethod
    def of(cls, params: dict, seed: int) -> Settings:
        return cls(
            int(params.get("n_estimators", 100)), float(params.get("learning_rate", 0.1)), int(params.get("num_leaves", 31)), int(params.get("max_depth", -1)),
            int(params.get("min_child_samples", 20)), float(params.get("subsample", 1.0)), int(params.get("subsample_freq", 0)),
            float(params.get("colsample_bytree", 1.0)), params.get("class_weight") == "balanced", seed,
        )

    def features(self, n: int, round_: int, k: int) -> np.ndarray:
        """Which features the tree of a round and class may use."""
        allowed = np.ones(n, bool)
        if self.column_share < 1:
            allowed[np.random.default_rng([self.seed, round_, k]).permutation(n)[max(1, round(self.column_share * n)) :]] = False
        return allowed

    def rows(self, ids: np.ndarray, round_: int) -> np.ndarray:
        """Which rows a round sees (all, unless rows are drawn every so many rounds)."""
        if self.row_every <= 0 or self.row_share >= 1:
            return np.ones(len(ids), bool)
        return uniform(ids, self.seed, round_ // self.row_every) < self.row_share


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    flat: int
    left: tuple[int, int, int]  # gradient and hessian sums, rows
    right: tuple[int, int, int]


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, layout: Layout, allowed: np.ndarray, least_rows: np.ndarray) -> tuple[list[Split | None], np.ndarray]:
    """The split of most gain of each node (rows of the arrays), the first on ties, and the nodes' (g, h) sums.

    A split sends a feature's bins up to its cut left. Both sides need ``least_rows`` rows and some hessian.
    """
    starts = layout.starts
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    total = [x[:, : starts[1]].sum(1) for x in (g, h, n)]

    def left_of(x: np.ndarray) -> np.ndarray:
        run = np.concatenate([np.zeros((len(x), 1)), np.cumsum(x, axis=1)], axis=1)
        return run[:, 1:] - run[:, starts[owner]]

    gl, hl, nl = left_of(g), left_of(h), left_of(n)
    gr, hr, nr = (t[:, None] - x for t, x in zip(total, (gl, hl, nl)))
    floor = LEAST_HESSIAN * SCALE
    fits = (nl >= least_rows[:, None]) & (nr >= least_rows[:, None]) & (hl >= floor) & (hr >= floor) & allowed[:, owner]
    fits[:, starts[1:] - 1] = False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, (gl * gl / hl + gr * gr / hr - (total[0] ** 2 / total[1])[:, None]) / SCALE, -np.inf)
    at = np.argmax(gain, axis=1)
    out: list[Split | None] = []
    for i, b in enumerate(at):
        left, right = (int(gl[i, b]), int(hl[i, b]), int(nl[i, b])), (int(gr[i, b]), int(hr[i, b]), int(nr[i, b]))
        out.append(Split(float(gain[i, b]), int(owner[b]), int(b), left, right) if gain[i, b] > LEAST_GAIN else None)
    return out, np.stack(total[:2], axis=1)


class Growth:
    """One tree, grown best gain first up to a number of leaves.

    A node's split doesn't depend on when it is made, so all nodes that may be among the best are looked at
    together: ``wanted`` goes through the known gains as best-first growth would, and names the children
    not looked at yet of every node taken. With none left, the nodes taken are the tree.
    """

    def __init__(self, settings: Settings):
        self.settings, self.nodes = settings, TreeNodes.root()
        self.splits: dict[int, Split | None] = {}
        self.depth, self.sums = [0], {}

    def _taken(self) -> list[int]:
        heap, taken = [], []
        if self.splits.get(0):
            heap.append((-self.splits[0].gain, 0))
        while heap and len(taken) < self.settings.leaves - 1:
            _, node = heapq.heappop(heap)
            taken.append(node)
            for kid in (self.nodes.left[node], self.nodes.right[node]):
                if kid >= 0 and self.splits.get(kid):
                    heapq.heappush(heap, (-self.splits[kid].gain, kid))
        return taken

    def wanted(self) -> list[int]:
        if 0 not in self.splits:
            return [0]
        new = []
        for node in sorted(self._taken()):
            if self.nodes.left[node] < 0:
                split = self.splits[node]
                kids = self.nodes.split(node, split.feature, split.flat)
                self.depth += [self.depth[node] + 1] * 2
                for kid, (*sums, rows) in zip(kids, (split.left, split.right)):
                    self.sums[kid] = sums
                    if 0 <= self.settings.depth <= self.depth[kid] or rows < 2 * self.settings.least_rows:
                        self.splits[kid] = None
                    else:
                        new.append(kid)
        return new

    def told(self, node: int, split: Split | None, sums: Sequence[float]) -> None:
        self.splits[node] = split
        self.sums.setdefault(node, (int(sums[0]), int(sums[1])))

    def finished(self) -> tuple[TreeNodes, np.ndarray]:
        """The nodes taken, renumbered, and every leaf's step (0 on inner nodes)."""
        taken, tree, values, stack = set(self._taken()), TreeNodes.root(), {}, [(0, 0)]
        while stack:
            old, new = stack.pop()
            if old in taken:
                kids = tree.split(new, self.splits[old].feature, self.splits[old].flat)
                stack += list(zip((self.nodes.left[old], self.nodes.right[old]), kids))
            else:
                g, h = self.sums[old]
                values[new] = -g / h * self.settings.learning_rate if h else 0.0
        return tree, np.array([values.get(i, 0.0) for i in range(len(tree.left))])


def gradients(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Softmax gradients and hessians (classes x rows) as whole multiples of 1 / SCALE; rows not seen count nothing."""
    e = np.exp(margins - margins.max(0))
    p = e / e.sum(0)
    k = len(margins)
    w = np.where(seen, weights[labels], 0.0) * SCALE
    y = labels == np.arange(k)[:, None]
    return np.rint((p - y) * w), np.rint(p * (1 - p) * w * (k / (k - 1) if k > 1 else 1.0))


def class_facts(counts: np.ndarray, balanced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row weight of each class and the starting margins, the logarithms of the weighted shares."""
    weights = counts.sum() / (len(counts) * counts) if balanced else np.ones(len(counts))
    held = weights * counts
    return weights, np.log(held / held.sum())


def class_orders(order: np.ndarray, k: int) -> np.ndarray:
    """Each feature's order of the rows of ``k`` classes one after another."""
    n = order.shape[1]
    return np.concatenate([order + c * n for c in range(k)], axis=1)


def sorted_splits(
    bins: np.ndarray, order: np.ndarray, slots: np.ndarray, count: int, g: np.ndarray, h: np.ndarray, layout: Layout, allowed: np.ndarray, least_rows: int
) -> tuple[list[Split | None], np.ndarray]:
    """What ``best_splits`` finds, from the rows themselves: sorted by slot within each feature's ``order`` (classes x
    rows one after another), running sums up to each change of bin are the left sides. Costs rows x features
    however many nodes and bins there are, which suits frames smaller than their histograms."""
    wide = order if order.shape[1] == len(slots) else class_orders(order, len(slots) // len(bins))
    held = slots >= 0
    wanted = int(held.sum())
    sums = np.zeros((count, 2))
    if not wanted:
        return [None] * count, sums
    # only rows with a slot are sorted, each feature has as many
    index = wide if wanted == len(slots) else wide[held[wide]].reshape(len(wide), wanted)
    features = np.arange(len(wide))[:, None]
    by_slot = np.argsort(slots.astype(np.int16 if count < 32_000 else np.int32).take(index), axis=1, kind="stable")
    index = index.take(by_slot + features * wanted)
    slot = np.sort(slots[held])
    first = np.searchsorted(slot, np.arange(count + 1))
    present = np.flatnonzero(np.diff(first))
    begin, end, size = first[slot], first[slot + 1], np.diff(first)[present]

    def summed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Running sums of a statistic, those before each slot present, and the slots' own."""
        run = np.cumsum(x.take(index), axis=1)
        ends = run[:, first[present + 1] - 1]
        base = np.concatenate([np.zeros((len(run), 1)), ends[:, :-1]], axis=1)
        return run.ravel(), base.ravel(), (ends - base)[0]

    (run_g, base_g, all_g), (run_h, base_h, all_h) = summed(g), summed(h)
    sums[present] = np.stack([all_g, all_h], axis=1)
    nl = np.arange(wanted) - begin + 1
    bin_ = np.tile(bins.T, len(slots) // len(bins)).take(index + features * len(slots))
    fits = np.zeros(bin_.shape, bool)
    fits[:, :-1] = bin_[:, 1:] != bin_[:, :-1]
    fits &= (nl >= least_rows) & (end - begin - nl >= least_rows) & (np.arange(wanted) + 1 < end) & allowed[slot].T
    # sides and gains only where a cut may be
    at = np.flatnonzero(fits)
    f_at = at // wanted
    s_at = np.repeat(np.arange(len(present)), size).take(at - f_at * wanted)
    b_at = f_at * len(present) + s_at
    gl, hl, gt, ht = run_g.take(at) - base_g.take(b_at), run_h.take(at) - base_h.take(b_at), all_g.take(s_at), all_h.take(s_at)
    gr, hr = gt - gl, ht - hl
    floor = LEAST_HESSIAN * SCALE
    gain = np.full(fits.shape, -np.inf)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain.ravel()[at] = np.where((hl >= floor) & (hr >= floor), (gl * gl / hl + gr * gr / hr - gt * gt / ht) / SCALE, -np.inf)
    top = np.maximum.reduceat(gain, first[present], axis=1)
    out: list[Split | None] = [None] * count
    for i, (s, f, best) in enumerate(zip(present, np.argmax(top, axis=0), top.max(0))):
        if best > LEAST_GAIN:
            at = first[s] + int(np.argmax(gain[f, first[s] : first[s + 1]]))
            n_left, n_all = at - first[s] + 1, first[s + 1] - first[s]
            cell, own = f * wanted + at, f * len(present) + i
            g_left, h_left = run_g[cell] - base_g[own], run_h[cell] - base_h[own]
            sides = (int(g_left), int(h_left), int(n_left)), (int(all_g[i] - g_left), int(all_h[i] - h_left), int(n_all - n_left))
            out[s] = Split(float(best), int(f), int(bin_[f, at]), *sides)
    return out, sums


def boost_local(bins: np.ndarray, labels: np.ndarray, ids: np.ndarray, counts: np.ndarray, layout: Layout, settings: Settings) -> TreeModel:
    """One trial on a frame that a task holds; the trees of a round's classes grow side by side."""
    weights, start = class_facts(counts, settings.balanced)
    n, k = len(labels), len(counts)
    margins, trees = np.repeat(start[:, None], n, axis=1), []
    order = class_orders(np.argsort(bins, axis=0, kind="stable").T, k)
    for round_ in range(settings.rounds):
        seen = settings.rows(ids, round_)
        g, h = gradients(margins, labels, weights, seen)
        growing = [Growth(settings) for _ in range(k)]
        where = [np.zeros(n, np.int64) for _ in range(k)]
        masks = [settings.features(bins.shape[1], round_, c) for c in range(k)]
        while any(asked := [growth.wanted() for growth in growing]):
            places = [(c, node) for c in range(k) for node in asked[c]]
            slots, at = [], 0
            for c in range(k):
                where[c] = growing[c].nodes.route(bins, where[c]) if asked[c] else where[c]
                slot_of = np.full(len(growing[c].nodes.left), -1)
                slot_of[asked[c]] = at + np.arange(len(asked[c]))
                slots.append(np.where(seen, slot_of[where[c]], -1))
                at += len(asked[c])
            allowed = np.array([masks[c] for c, _ in places])
            splits, sums = sorted_splits(bins, order, np.concatenate(slots), at, g.ravel(), h.ravel(), layout, allowed, settings.least_rows)
            for (c, node), split, s in zip(places, splits, sums):
                growing[c].told(node, split, s)
        for c, growth in enumerate(growing):
            tree, step = growth.finished()
            margins[c] += step[tree.route(bins, np.zeros(n, np.int64))]
            trees.append((tree, step[:, None] * (np.arange(k) == c)))
    return pack(trees, layout, start, True)


def boost_table(blocks: DataFrame, features: int, counts: np.ndarray, layout: Layout, trials: list[Settings]) -> list[TreeModel]:
    """All trials on a frame that stays distributed. Every step is one aggregate of gradient sums by (trial and
    class and node, bin) for all of them, combined in the tasks and summed by Spark; best splits are found by node
    there too, and the driver sees one row per node. Margins are written anew after each round."""
    width, k = int(layout.starts[-1]), len(counts)
    facts = [class_facts(counts, t.balanced) for t in trials]

    def first_margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.concatenate([np.repeat(s[:, None], n, axis=1) for _, s in facts]).tobytes() for n in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, "margins"])

    kept = "block long, n long, bins binary, labels binary, ids binary, margins binary"
    state = checkpointed(blocks.mapInArrow(first_margins, kept))
    forests: list[list] = [[] for _ in trials]

    def opened(batch: pa.RecordBatch) -> Iterator[tuple]:
        for row in batch.to_pylist():
            yield *unpack(row, features), np.frombuffer(row["margins"]).reshape(len(trials), k, -1)

    for round_ in range(max(t.rounds for t in trials)):
        active = [i for i, t in enumerate(trials) if round_ < t.rounds]
        growing = {(i, c): Growth(trials[i]) for i in active for c in range(k)}
        while asked := {key: nodes for key, growth in growing.items() if (nodes := growth.wanted())}:
            places = [(key, node) for key, nodes in asked.items() for node in nodes]
            first = {key: next(j for j, p in enumerate(places) if p[0] == key) for key in asked}
            trees = {key: growing[key].nodes for key in asked}
            masks = np.array([trials[i].features(features, round_, c) for (i, c), _ in places])
            least = np.array([trials[i].least_rows for (i, _), _ in places])

            def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for bins, labels, ids, margins in opened(batch):
                        for i in sorted({i for i, _ in asked}):
                            seen = trials[i].rows(ids, round_)
                            g, h = gradients(margins[i], labels, facts[i][0], seen)
                            for key in (x for x in asked if x[0] == i):
                                where = trees[key].route(bins, np.zeros(len(labels), np.int64))
                                slot_of = np.full(len(trees[key].left), -1)
                                slot_of[asked[key]] = np.arange(len(asked[key]))
                                slots = np.where(seen, slot_of[where], -1)
                                found = histograms(bins, slots, len(asked[key]), width, [g[key[1]], h[key[1]], seen.astype(np.float64)])
                                at = np.flatnonzero(found[2])
                                place = at // width + first[key]
                                columns = [place.astype(np.int32), (at % width).astype(np.int32), *(x.ravel()[at].astype(np.int64) for x in found)]
                                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "bin", "g", "h", "n"])

            def choose(group: pa.Table) -> pa.Table:
                place, at = group.column("place")[0].as_py(), np.asarray(group.column("bin"))
                dense = []
                for name in ("g", "h", "n"):
                    dense.append(np.zeros((1, width)))
                    dense[-1][0, at] = np.asarray(group.column(name))
                [split], [sums] = best_splits(*dense, layout, masks[place : place + 1], least[place : place + 1])
                return pa.table({"place": pa.array([place], pa.int32()), "found": [pickle.dumps((split and astuple(split), sums.tolist()))]})

            summed = (
                state.select("bins", "labels", "ids", "margins").mapInArrow(count, "place int, bin int, g long, h long, n long")
                .groupBy("place", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
            )
            for row in summed.groupBy("place").applyInArrow(choose, "place int, found binary").collect():
                key, node = places[row["place"]]
                split, sums = pickle.loads(bytes(row["found"]))
                growing[key].told(node, split and Split(*split), sums)
            for key, node in places:
                if node not in growing[key].splits:  # no row reached it
                    growing[key].told(node, None, np.zeros(2))
        done = {key: growth.finished() for key, growth in growing.items()}
        for (i, c), (tree, step) in done.items():
            forests[i].append((tree, step[:, None] * (np.arange(k) == c)))

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for bins, labels, _, margins in opened(batch):
                    margins = margins.copy()
                    for (i, c), (tree, step) in done.items():
                        margins[i, c] += step[tree.route(bins, np.zeros(len(labels), np.int64))]
                    out.append(margins.tobytes())
                yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array(out, pa.binary()))

        state = checkpointed(state.mapInArrow(moved, kept))
    return [pack(f, layout, s, True) for f, (_, s) in zip(forests, facts)]


def fit_trees(data: BinnedFrame, trials: list[Settings]) -> list[TreeModel]:
    """One ensemble per trial, over the classes seen."""
    if data.counts.sum() > LOCAL_ROWS:
        return boost_table(data.blocks, data.features, data.counts, data.layout, trials)
    return fit_locally(data, boost_local, trials)
