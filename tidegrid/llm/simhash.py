"""SimHash near-dedup: a binary trie over fingerprints joined with itself under a Hamming budget."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import checkpoint, join_hot, pick, utf8
from tidegrid.llm.graph import components

SHINGLE, SEED, BITS = 3, 42, 64
#: Distinct fingerprints below a trie node that is no longer split: one task holds two such nodes.
LEAF = 4096
#: Bits by which the upper trie grows in one step.
STRIDE = 4
#: Bytes of a text whose words are held at once, and node pairs held at once.
WINDOW_BYTES, FRONTIER = 1 << 20, 1 << 18
#: Node pairs with so few leaf pairs are compared leaf by leaf.
FEW = 16

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def _windows(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``WINDOW_BYTES``, cut at white space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + WINDOW_BYTES)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        total += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


def simhash(text: bytes) -> int:
    """The 64-bit fingerprint of a UTF-8 text: bit i is set if over half of the shingles' hashes have it.

    A-Z are lower-cased; shingles are three consecutive words joined by one space, repeats counted. Fewer words
    are one shingle; without words the fingerprint is 0. Long texts are walked in windows, so memory
    doesn't grow with their length (one word is held whole).
    """
    counts, n, carried = np.zeros(BITS, np.int64), 0, []
    for window in _windows(text):
        ws = carried + window.lower().split()
        if len(ws) >= SHINGLE:
            hashes = np.fromiter(map(_hash, map(b" ".join, zip(*(ws[i:] for i in range(SHINGLE))))), np.uint64, len(ws) - SHINGLE + 1)
            counts += _bit_counts(hashes)
            n += len(hashes)
        carried = ws[-(SHINGLE - 1) :]
    if not n and carried:
        n, counts = 1, _bit_counts(np.array([_hash(b" ".join(carried))], np.uint64))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]) if n else 0


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of (doc_id, text); the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(map(simhash, utf8(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def _rooted(labels: np.ndarray) -> np.ndarray:
    while True:
        above = labels[labels]
        if np.array_equal(above, labels):
            return labels
        labels = above


def _joined(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after the links x - y: the larger root hangs below the least root that it meets, until all agree."""
    while True:
        rx, ry = labels[x], labels[y]
        open_ = rx != ry
        if not open_.any():
            return labels
        x, y = x[open_], y[open_]
        high, low = np.maximum(rx, ry)[open_], np.minimum(rx, ry)[open_]
        np.minimum.at(labels, high, low)
        labels = _rooted(labels)


def trie_links(a: np.ndarray, b: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted distinct 64-bit values ``a`` and ``b`` (None: ``a`` itself) are connected by pairs that
    differ in at most ``budget`` bits, as (value, root) edges: a spanning forest, not all pairs.

    The sorted values are a binary trie: a node is a range of them, and the bits' running sums give the
    place where a range splits. Pairs of nodes descend together; a pair whose paths differ in more bits
    than the budget is pruned, a pair of few leaves is compared outright. Pairs wait on a stack
    in pieces of ``FRONTIER``, so memory is bounded.
    """
    same = b is None
    values = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    b = a if same else b
    labels = np.arange(len(values))
    if not len(a) or not len(b):
        return values[:0], values[:0]

    def ones(v: np.ndarray, bit: int) -> np.ndarray:
        return np.concatenate([[0], np.cumsum((v >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])

    sums = {}
    stack = [(BITS - 1, *(np.array([n], np.int64) for n in (0, len(a), 0, len(b), 0)))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        few = ((ahi - alo) * (bhi - blo) <= FEW) | (bit < 0)
        if few.any():
            la, lb = (ahi - alo)[few], (bhi - blo)[few]
            size = la * lb
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            wide = np.repeat(lb, size)
            x, y = np.repeat(alo[few], size) + at // wide, np.repeat(blo[few], size) + at % wide
            near = np.bitwise_count(a[x] ^ b[y]) <= budget
            if same:
                near &= x < y
            labels = _joined(labels, x[near], y[near] + shift)
            alo, ahi, blo, bhi, err = (v[~few] for v in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        if bit not in sums:
            sums[bit] = (ones(a, bit), ones(b, bit))
        ca, cb = sums[bit]
        amid, bmid = ahi - (ca[ahi] - ca[alo]), bhi - (cb[bhi] - cb[blo])
        children = [
            (alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1), (amid, ahi, blo, bmid, err + 1),
        ]
        parts = []
        for k, (l1, h1, l2, h2, e) in enumerate(children):
            live = (h1 > l1) & (h2 > l2) & (e <= budget)
            if same and k == 3:
                live &= alo != blo  # the mirror of the pair before
            parts.append([v[live] for v in (l1, h1, l2, h2, e)])
        grown = [np.concatenate(column) for column in zip(*parts)]
        for at in range(0, len(grown[0]), FRONTIER):
            stack.append((bit - 1, *(v[at : at + FRONTIER] for v in grown)))
    linked = np.flatnonzero(labels != np.arange(len(values)))
    return values[linked], values[labels[linked]]


def _prefix(fp: Column, depth: int) -> Column:
    return F.shiftrightunsigned(fp, BITS - depth) if depth else F.lit(0).cast("long")


def _upper_trie(fps: DataFrame, budget: int, leaf: int) -> tuple[DataFrame, DataFrame]:
    """The nodes where splitting ends, with their values (depth, prefix, fps), and the pairs of them
    (a_depth, a, b_depth, b) that the budget lets meet.

    All nodes that hold more than ``leaf`` values split by ``STRIDE`` bits at once; pairs of nodes go down
    together and add the bits in which their new digits differ. A node that ended earlier waits for the other one.
    """
    spark = fps.sparkSession
    depth, rest, ended = 0, fps, []
    pairs = spark.range(1).select(
        F.lit(0).alias("a_depth"), F.lit(0).cast("long").alias("a"), F.lit(0).alias("b_depth"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("err")
    )
    if fps.limit(leaf + 1).count() <= leaf:
        held = fps.groupBy().agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        return held.select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"), "fps"), pairs.drop("err")
    while True:
        deeper = depth + STRIDE
        named = rest.withColumns({"parent": _prefix(F.col("fp"), depth), "prefix": _prefix(F.col("fp"), deeper)})
        kids = checkpoint(named.groupBy("parent", "prefix").agg(F.count(F.lit(1)).alias("n")))
        for side in "ab":
            grown = kids.select(F.lit(depth).alias(f"{side}_depth"), F.col("parent").alias(side), F.col("prefix").alias(f"{side}_kid"))
            pairs = pairs.join(grown, [f"{side}_depth", side], "left")
        both = F.col("a_kid").isNotNull() & F.col("b_kid").isNotNull()
        err = F.col("err") + F.when(both, F.bit_count(F.col("a_kid").bitwiseXOR(F.col("b_kid")).bitwiseAND(F.lit((1 << STRIDE) - 1)))).otherwise(0)
        mirror = (F.col("a_depth") == F.col("b_depth")) & (F.col("a") == F.col("b")) & (F.col("a_kid") > F.col("b_kid"))
        pairs = checkpoint(
            pairs.where(~F.coalesce(mirror, F.lit(False))).select(
                *(F.when(F.col(f"{s}_kid").isNotNull(), deeper).otherwise(F.col(f"{s}_depth")).alias(f"{s}_depth") for s in "ab"),
                *(F.coalesce(f"{s}_kid", s).alias(s) for s in "ab"), err.cast("long").alias("err"),
            ).where(F.col("err") <= budget)
        )
        depth = deeper
        large = kids.where(F.col("n") > leaf).select("prefix")
        done = named.join(kids.where(F.col("n") <= leaf).select("prefix"), "prefix", "left_semi")
        ended.append(done.groupBy("prefix").agg(F.sort_array(F.collect_list("fp")).alias("fps")).select(F.lit(depth).alias("depth"), "prefix", "fps"))
        if large.isEmpty():
            break
        rest = named.join(large, "prefix", "left_semi").select("fp")
    held = ended[0]
    for more in ended[1:]:
        held = held.unionByName(more)
    return checkpoint(held), pairs.select("a_depth", "a", "b_depth", "b")


def _links(fps: DataFrame, budget: int, leaf: int) -> DataFrame:
    """(a, b) links among distinct fingerprints: spanning forests of every pair of lower tries."""
    held, pairs = _upper_trie(fps, budget, leaf)
    for side in "ab":
        side_held = held.select(F.col("depth").alias(f"{side}_depth"), F.col("prefix").alias(side), F.col("fps").alias(f"{side}_fps"))
        pairs = pairs.join(side_held, [f"{side}_depth", side])
    same = (F.col("a_depth") == F.col("b_depth")) & (F.col("a") == F.col("b"))
    blocks = pairs.select(same.alias("same"), "a_fps", F.when(~same, F.col("b_fps")).alias("b_fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(k)[i].values for k in (1, 2))
                a = np.sort(np.asarray(a).view(np.uint64))
                b = None if batch.column(0)[i].as_py() else np.sort(np.asarray(b).view(np.uint64))
                x, y = (v.view(np.int64) for v in trie_links(a, b, budget))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return blocks.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, budget: int = 2, key: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row: fingerprints that differ in at most ``budget`` bits are linked,
    and component_id is the least doc_id reachable, itself included.

    1. Equal fingerprints are one value (a combining aggregate, so copies cost no pairs).
    2. The distinct values form a binary trie, joined with itself: pairs of nodes descend together, add up
       differing bits, and are pruned beyond the budget. Down to nodes of ``leaf`` values this is
       a table of node pairs; each remaining pair of nodes is walked on in one task, which holds two
       sorted arrays of at most ``leaf`` values. As values are distinct, one has at most
       64 + 64 * 63 / 2 partners within two bits, and a task tells a spanning forest of them.
    3. Components of those links; values that a thousandth of all rows hold (at most 1000 of them) meet their
       rows by broadcast, all others by a shuffle.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows without an id have the
    component of the rows with ids that share their fingerprint, null if there are none. Repeated rows
    get equal results; other columns don't matter; an empty table gives no rows.
    """
    plain = pick(docs, key, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = checkpoint(with_fingerprints(plain))
    values = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    joined = components(_links(values.select("fp"), budget, leaf))
    rooted = values.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = checkpoint(rooted.join(heads, "root").select("fp", "n", "component_id"))
    return join_hot(rows, named, "fp", "n").select(
        F.col("doc_id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
