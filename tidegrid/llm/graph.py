"""Connected components by large-star / small-star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import checkpoint

#: Edges that a task contracts at a time; a graph of no more is done in one task.
LOCAL_EDGES = 200_000


def _star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node) for every node that these edges connect with a lesser one."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, up := root[root]):
            root = up
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def _contracted(edges: DataFrame) -> DataFrame:
    """The same connections with fewer edges: in every task, block by block, nodes are tied to the least one that the block's
    edges reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest() -> pa.RecordBatch:
            a, b = (np.concatenate([np.asarray(x.column(i)) for x in held]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in _star_forest(a, b)], names=["a", "b"])

        held, rows = [], 0
        for batch in batches:
            if held and rows + batch.num_rows > block:
                yield forest()
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield forest()

    block = LOCAL_EDGES
    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "a long, b long")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is tied to the node's least neighbour (itself
    included); small star: every smaller one is, and the node too. Least neighbours are an aggregate
    joined back, so a node with very many neighbours is combined before the shuffle and split by
    adaptive execution after it."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return near.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("u", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, a <> b) that isn't itself the least of its
    component; ``root`` is that least node. No edges give no rows."""
    state = checkpoint(_contracted(edges.where("a <> b")))
    seen = None
    while True:
        print_of = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        small = print_of[0] <= LOCAL_EDGES  # needs no shuffles, which write files for each of their partitions
        if small or print_of == seen:
            found = checkpoint(_contracted(state.coalesce(1))) if small else state
            return found.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = print_of
        state = checkpoint(_contracted(_stars(_stars(state, True), False)))
