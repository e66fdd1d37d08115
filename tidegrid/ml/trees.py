"""Tree ensembles as node tables: binned frames, split search over histograms, prediction, persistence."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import checkpointed

#: Quantiles from which a feature's cuts are taken; fewer distinct values are cut half way between all of them.
QUANTILES = 255
#: Rows of one block of a binned frame.
BLOCK_ROWS = 1 << 16
#: A binned frame of at most so many rows (some 20 bytes each) is broadcast, and every trial is one task's
#: work. A larger one stays distributed: all trials share each histogram aggregate. Both give the same trees.
LOCAL_ROWS = 200_000
#: Statistics are summed as whole numbers of 1 / SCALE, so sums don't depend on the order of rows.
SCALE = 1 << 24
#: Row-tree pairs that one prediction step holds.
PREDICT_CELLS = 1 << 21


@dataclass(frozen=True)
class Layout:
    """Where the features' bins lie in one flat axis. Bin b of a feature holds values up to its cut b, the last bin the rest."""

    cuts: tuple[tuple[float, ...], ...]

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum([0, *(len(c) + 1 for c in self.cuts)])

    def bins(self, values: np.ndarray) -> np.ndarray:
        """Flat bin numbers (rows x features)."""
        starts = self.starts
        return np.stack([starts[f] + np.searchsorted(c, values[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1).astype(np.int32)

    def place(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature, cut) of flat bins."""
        starts = self.starts
        feature = np.searchsorted(starts, flat, side="right") - 1
        return feature, np.array([self.cuts[f][b - starts[f]] for f, b in zip(feature, flat)], np.float64)


def learn_layout(frame: DataFrame, features: list[str]) -> Layout:
    """Cuts half way between neighbouring quantiles of each feature; one mergeable sketch a feature."""
    share = [i / (QUANTILES - 1) for i in range(QUANTILES)]
    found = frame.agg(*(F.percentile_approx(F.col(f).cast("double"), share, 10_000).alias(f) for f in features)).first()
    return Layout(tuple(tuple(a / 2 + b / 2 for a, b in pairwise(sorted(set(found[f] or [])))) for f in features))


def binned_blocks(frame: DataFrame, features: list[str], label: str, layout: Layout) -> DataFrame:
    """(block, rows, bins, labels, ids) of a labelled frame: columns of ``BLOCK_ROWS`` rows as packed arrays."""
    uid = F.monotonically_increasing_id()
    plain = frame.select(*(F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)), F.col(label).cast("int").alias("label"), uid.alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                columns = [np.asarray(c) for c in part.columns]
                bins = layout.bins(np.stack(columns[: len(features)], axis=1))
                packed = (bins.astype("<i4").tobytes(), columns[-2].astype("<i4").tobytes(), columns[-1].astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (int(columns[-1][0]), part.num_rows, *packed)], ["block", "n", "bins", "labels", "ids"])

    return plain.mapInArrow(run, "block long, n long, bins binary, labels binary, ids binary")


@dataclass(frozen=True)
class BinnedFrame:
    """A labelled frame as blocks of binned rows; labels are places in ``counts``, the classes' numbers of rows."""

    blocks: DataFrame
    layout: Layout
    features: int
    counts: np.ndarray


def binned_frame(frame: DataFrame, features: list[str], label: str, classes: tuple[int, ...], counts: list[int]) -> BinnedFrame:
    layout = learn_layout(frame, features)
    known = F.array_position(F.array(*map(F.lit, classes)), F.col(label)).cast("int") - 1
    blocks = checkpointed(binned_blocks(frame.withColumn("_class", known), features, "_class", layout))
    return BinnedFrame(blocks, layout, len(features), np.array(counts, np.float64))


def unpack(row: dict, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, labels, ids) of a block."""
    return np.frombuffer(row["bins"], "<i4").reshape(-1, features), np.frombuffer(row["labels"], "<i4"), np.frombuffer(row["ids"], "<i8")


def uniform(ids: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on row ids and salt only, so any task draws the same."""
    x = ids.astype(np.uint64)
    for s in salt:
        x = (x ^ np.uint64(s & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def histograms(bins: np.ndarray, slots: np.ndarray, count: int, width: int, stats: list[np.ndarray]) -> list[np.ndarray]:
    """Sums (count x width) of each statistic by slot and flat bin, over rows with a slot (-1: none)."""
    rows = np.flatnonzero(slots >= 0)
    index = (slots[rows, None].astype(np.int64) * width + bins[rows]).ravel()
    return [np.bincount(index, np.repeat(s[rows], bins.shape[1]), count * width).reshape(count, width) for s in stats]


@dataclass
class TreeNodes:
    """Growing tree: per node the flat bin of its cut, and children (-1: none yet)."""

    feature: list[int]
    flat: list[int]
    left: list[int]
    right: list[int]

    @classmethod
    def root(cls) -> TreeNodes:
        return cls([0], [0], [-1], [-1])

    def split(self, node: int, feature: int, flat: int) -> tuple[int, int]:
        self.feature[node], self.flat[node] = feature, flat
        self.left[node], self.right[node] = len(self.left), len(self.left) + 1
        for _ in range(2):
            for column, empty in ((self.feature, 0), (self.flat, 0), (self.left, -1), (self.right, -1)):
                column.append(empty)
        return self.left[node], self.right[node]

    def route(self, bins: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The frontier node of every row, from the nodes ``where`` they are now."""
        feature, flat, left, right = (np.array(c, np.int32) for c in (self.feature, self.flat, self.left, self.right))
        rows = np.arange(len(where))
        while True:
            inner = left[where] >= 0
            if not inner.any():
                return where
            at = where[inner]
            goes = bins[rows[inner], feature[at]] <= flat[at]
            where = where.copy()
            where[inner] = np.where(goes, left[at], right[at])


@dataclass(frozen=True)
class TreeModel:
    """An ensemble as one node table: roots, cuts on feature values, children (a leaf is its own child) and a value per
    class. ``softmax`` ensembles add their values up, others take the mean."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: np.ndarray
    softmax: bool

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities (rows x classes)."""
        total = np.zeros((len(x), self.value.shape[1]))
        step = max(1, PREDICT_CELLS // max(1, len(self.roots)))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            rows, node = np.arange(len(part))[:, None], np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            while True:
                below = np.where(part[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
                if np.array_equal(below, node):
                    break
                node = below
            for k in range(total.shape[1]):
                total[at : at + step, k] = self.value[:, k][node].sum(1)
        if not self.softmax:
            return total / max(1, len(self.roots))
        e = np.exp(total + self.start - (total + self.start).max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def column(self, features: list[Column], classes: int) -> Column:
        """Probabilities of each row as an array, computed on Arrow batches; the model travels with the task."""

        @F.pandas_udf("array<double>")
        def of(*columns: pd.Series) -> pd.Series:
            return pd.Series(list(self.probabilities(np.stack([c.to_numpy(np.float64) for c in columns], axis=1))))

        return of(*features)

    def save(self, spark: SparkSession, path: str) -> None:
        columns = {"node": np.arange(len(self.feature)), "feature": self.feature, "threshold": self.threshold, "left": self.left, "right": self.right}
        nodes = pa.table({**columns, "value": pa.array(self.value.tolist(), pa.list_(pa.float64()))})
        spark.createDataFrame(nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = json.dumps({"roots": self.roots.tolist(), "start": self.start.tolist(), "softmax": self.softmax})
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values("node")
        head = json.loads(spark.read.text(f"{path}/head").first()["value"])
        return cls(
            np.array(head["roots"], np.int64), nodes["feature"].to_numpy(np.int32), nodes["threshold"].to_numpy(np.float64), nodes["left"].to_numpy(np.int64),
            nodes["right"].to_numpy(np.int64), np.stack([np.asarray(v) for v in nodes["value"]]), np.array(head["start"], np.float64), bool(head["softmax"]),
        )


def pack(trees: list[tuple[TreeNodes, np.ndarray]], layout: Layout, start: np.ndarray, softmax: bool) -> TreeModel:
    """One node table of grown trees with their node values (nodes x classes)."""
    sizes = np.array([len(t.left) for t, _ in trees])
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(trees) else np.zeros(0, np.int64)
    feature = np.concatenate([np.array(t.feature, np.int32) for t, _ in trees])
    flat = np.concatenate([np.array(t.flat, np.int64) for t, _ in trees])
    left, right = (np.concatenate([np.array(getattr(t, side), np.int64) for t, _ in trees]) for side in ("left", "right"))
    inner, offset = left >= 0, np.repeat(base, sizes)
    threshold = np.full(len(flat), np.inf)
    feature[~inner] = 0
    if inner.any():
        threshold[inner] = layout.place(flat[inner])[1]
    own = np.arange(len(flat))
    return TreeModel(
        base.astype(np.int64), feature, threshold, np.where(inner, left + offset, own), np.where(inner, right + offset, own), np.concatenate([v for _, v in trees]), start, softmax
    )


def fit_locally(data: BinnedFrame, fit: Callable, trials: list) -> list[TreeModel]:
    """Trials as tasks of one job over a broadcast frame of at most ``LOCAL_ROWS`` rows."""
    spark = data.blocks.sparkSession
    parts = [unpack(r.asDict(), data.features) for r in data.blocks.collect()]
    order = np.argsort(np.concatenate([ids for _, _, ids in parts]), kind="stable")
    whole = spark.sparkContext.broadcast([np.concatenate([p[i] for p in parts])[order] for i in range(3)])
    counts, layout = data.counts, data.layout

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                model = fit(*whole.value, counts, layout, trials[i])
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([pickle.dumps(vars(model))], pa.binary())], ["id", "model"])

    rows = spark.range(0, len(trials), 1, len(trials)).mapInArrow(run, "id long, model binary").collect()
    models = {r["id"]: TreeModel(**pickle.loads(bytes(r["model"]))) for r in rows}
    return [models[i] for i in range(len(trials))]
