"""MinHash near-dedup: a multi-index Hamming join over signatures of 16-bit MinHash values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import Memo, checkpoint, pick, text_slices, utf8
from tidegrid.llm.graph import components

SHINGLE = 5
#: A signature has CHUNKS x CHUNK values; within a chunk one error is allowed. By the pigeonhole
#: principle two signatures that differ in at most 2 * CHUNKS - 1 = 23 of 60 values have a chunk with
#: at most one error, so they share a key that leaves the erring position out. At a similarity of 0.75
#: a chunk fails with probability 0.37, all twelve with 6e-6; at 0.1 a pair meets with 0.5 %.
CHUNKS, CHUNK = 12, 5
VALUES = CHUNKS * CHUNK
#: Members of a candidate group that are compared with as many others in one task.
BLOCK = 512
SLICE_BYTES = 4 << 20

_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, VALUES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_memo() -> Memo:
    return Memo(lambda ws: map(xxhash.xxh64_intdigest, ws), 400_000)


def shingle_sets(texts: list[bytes], memo: Memo) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its 5-word shingles (A-Z in lower case). With fewer
    words, the whole sequence is one shingle; without words, the set is empty."""
    split = [t.lower().split() for t in texts]
    known = memo.of(set().union(*split))
    out = []
    for ws in split:
        n = len(ws)
        h = np.fromiter(map(known.__getitem__, ws), np.uint64, n)
        if n >= SHINGLE:
            s = h[: n - SHINGLE + 1].copy()
            for k in range(1, SHINGLE):
                s = _mixed(s * _MULTIPLY + h[k : n - SHINGLE + 1 + k])
        elif n:
            s = np.array([n], np.uint64)
            for k in range(n):
                s = _mixed(s * _MULTIPLY + h[k])
        else:
            s = h
        out.append(np.unique(s))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of VALUES 16-bit MinHash values per set (an empty set: zeros)."""
    out = np.zeros((len(sets), VALUES), np.int16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        every = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0, *(len(sets[i]) for i in full[:-1])])
        for k in range(VALUES):
            least = np.minimum.reduceat(_mixed(every ^ _SEEDS[k]), starts)
            out[full, k] = (_mixed(least) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
    return out


def _list_array(rows: list[np.ndarray] | np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(rows) if len(rows) else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat, kind))


def with_signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, n_shingles, digest, signature); equal sets have equal digests."""
    schema = "doc_id long, n_shingles long, digest binary, signature array<smallint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        for batch in batches:
            for a, b in text_slices(batch, 1, SLICE_BYTES):
                part = batch.slice(a, b - a)
                sets = shingle_sets(utf8(part.column(1)), memo)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(map(digest_of, sets), pa.binary()),
                        _list_array(signatures(sets), pa.int16()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "signature"],
                )

    return docs.mapInArrow(run, schema)


def digest_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def node_of(digest: Column) -> Column:
    """The number of a class in graphs, by its sets' digest and not by an id, which texts may share."""
    return F.xxhash64(digest)


def with_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (node, shingles): the full sets, for confirming."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        for batch in batches:
            for a, b in text_slices(batch, 1, SLICE_BYTES):
                sets = shingle_sets(utf8(batch.slice(a, b - a).column(1)), memo)
                digests = pa.array(map(digest_of, sets), pa.binary())
                yield pa.RecordBatch.from_arrays([digests, _list_array([s.view(np.int64) for s in sets], pa.int64())], names=["digest", "shingles"])

    found = docs.mapInArrow(run, "digest binary, shingles array<bigint>")
    return found.select(node_of(F.col("digest")).alias("node"), "shingles")


def with_digest(docs: DataFrame, text: str) -> DataFrame:
    """All columns and ``digest``, that of the set of ``text``."""
    names = [*docs.columns, "digest"]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        for batch in batches:
            for a, b in text_slices(batch, at, SLICE_BYTES):
                part = batch.slice(a, b - a)
                digests = pa.array(map(digest_of, shingle_sets(utf8(part.column(at)), memo)), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, digests], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("digest", T.BinaryType())]))


def _keys(signature: Column) -> Column:
    """Per chunk and erring position, a key over the other values of the chunk."""
    keys = []
    for chunk in range(CHUNKS):
        for wrong in range(CHUNK):
            rest = [F.get(signature, F.lit(chunk * CHUNK + i)) for i in range(CHUNK) if i != wrong]
            keys.append(F.xxhash64(F.lit(chunk * CHUNK + wrong), *rest))
    return F.array(*keys)


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of ``nodes`` and of other texts with their ids; only texts with such an id are shingled again."""
    ids = classes.join(nodes.distinct(), "node", "left_semi").select("least").distinct()
    return checkpoint(with_sets(docs.join(ids, docs["doc_id"] == ids["least"], "left_semi")))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}")) for x in "ab")
    shared = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - shared
    return pairs.join(a, "a").join(b, "b").where(F.lit(100) * shared >= F.lit(75) * union).select("a", "b").distinct()


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Links (a, b) between components, from the full sets of one block of members (``left``) and another:
    inverted lists of the right block give all overlaps of a set at once. Only links that join
    components not yet joined in this block are told, so a dense group doesn't give all its pairs."""
    left = np.array(table.column("left"), bool)
    nodes, labels = np.array(table.column("node")), np.array(table.column("label"))
    values = table.column("shingles").combine_chunks()
    flat, ends = np.asarray(values.values), np.asarray(values.offsets)
    right = np.flatnonzero(~left)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(right)), sizes[right])
    posted = np.concatenate([flat[ends[r] : ends[r + 1]] for r in right]) if len(right) else flat[:0]
    order = np.argsort(posted, kind="stable")
    posted, owner = posted[order], owner[order]
    root = {int(x): int(x) for x in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a, b = [], []
    for i in np.flatnonzero(left):
        mine = flat[ends[i] : ends[i + 1]]
        lo, hi = np.searchsorted(posted, mine, "left"), np.searchsorted(posted, mine, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        shared = np.bincount(owner[at], minlength=len(right))
        for j in right[100 * shared >= 75 * (len(mine) + sizes[right] - shared)]:
            x, y = find(int(labels[i])), find(int(labels[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(int(labels[i]))
                b.append(int(labels[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _between_components(stars: DataFrame, first: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between first components (named by their roots) within groups of classes that keys
    connect. In a group with several components, every class outside the largest one meets every class
    of the group, block by block, so pairs inside the largest component are never compared."""
    joined = components(stars)
    ends = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    members = (
        ends.join(joined.withColumnRenamed("root", "group"), "node", "left").join(first.withColumnRenamed("root", "label"), "node", "left")
        .select("node", F.coalesce("group", "node").alias("group"), F.coalesce("label", "node").alias("label"))
    )
    members = checkpoint(members)
    per_label = members.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    groups = (
        per_label.groupBy("group").agg(F.count(F.lit(1)).alias("labels"), F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"))
        .where("labels > 1").select("group", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    held = members.join(groups, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(sets, "node")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = held.where("label <> main").select("group", F.col("block").alias("x"), F.explode(every).alias("y"), F.lit(True).alias("left"), "node", "label", "shingles")
    right = held.select("group", F.explode(every).alias("x"), F.col("block").alias("y"), F.lit(False).alias("left"), "node", "label", "shingles")
    return left.unionByName(right).groupBy("group", "x", "y").applyInArrow(_compare_blocks, "a long, b long").distinct()


def _judged(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id, kept) per row, as ``near_duplicates`` has them."""
    plain = pick(docs, key, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = checkpoint(with_signatures(plain))
    known = rows.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
    classes = checkpoint(known.agg(F.min("doc_id").alias("least"), F.first("signature").alias("signature")).withColumn("node", node_of(F.col("digest"))))
    keyed = classes.select("node", F.explode(_keys(F.col("signature"))).alias("key"))
    # the hub is the least node and not that of the least id, so ids aren't shuffled sixty times
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1").select("key", "hub")
    stars = checkpoint(
        keyed.join(shared, "key").where("node <> hub").groupBy(F.col("node").alias("a"), F.col("hub").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    )
    sets = _sets_of(stars.select(F.explode(F.array("a", "b")).alias("node")), classes, plain)
    nearest = stars.groupBy("a").agg(F.max_by("b", F.struct("n", F.bitwise_not("b"))).alias("b"))
    first = components(_linked(nearest, sets))
    second = components(_between_components(stars.select("a", "b"), first, sets))
    rooted = checkpoint(
        classes.select("digest", "least", "node").join(first, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("node"))
        .join(second, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    )
    heads = rooted.groupBy("root").agg(F.min(F.struct("least", "digest")).alias("head"))
    named = rooted.join(heads, "root").select("digest", "head")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("head.least", "doc_id"))
    alone = F.col("doc_id").isNull() | F.col("head").isNull()
    kept = alone | ((F.col("doc_id") == F.col("head.least")) & (F.col("digest") == F.col("head.digest")))
    return rows.join(named, "digest", "left").select(
        "doc_id", "digest", "n_shingles", component.cast("long").alias("component_id"), kept.alias("kept")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row: documents with 100 * |A and B| >= 75 * |A or B|
    over distinct 5-word shingles are linked, and component_id is the least doc_id reachable.

    1. Rows with equal sets form a class, numbered by its digest (a combining aggregate, so copies cost
       no pairs). Empty texts form no class and are their own component.
    2. A class emits one key for every chunk and allowed error. Of each key with several classes, the
       one of least number is the hub; a class is compared with the hub it shares most keys with, and confirmed links
       give first components. A group of near copies so costs one comparison a member, not all pairs.
    3. Groups of classes that keys connect and that still hold several components give the rest: their
       full sets are compared in blocks, all but pairs inside the group's largest component. So
       each pair that shares a key lies in one component or was compared in full.

    A row without an id is in no component and kept. Repeated rows get equal results. Rows that share an
    id but not the text follow the class of their own text; where texts with the least id are in one component,
    that of the least digest is kept. An empty table gives no rows.
    """
    return _judged(docs, key, text).select(F.col("doc_id").alias(key), "n_shingles", "component_id", "kept")


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: one of each group of near duplicates, that of the least id.

    Each id and shingle set is judged by itself, so texts that share an id neither take each other along
    nor stand in for each other. Of repeated rows with one id and one set, that with the least hash of
    all columns stays; rows without an id stay.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain, at = docs.toDF(*names), names[docs.columns.index(key)]
    chosen = _judged(docs, key, text).where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    chosen = checkpoint(chosen.agg(F.count(F.lit(1)).alias("n")))
    digested = with_digest(plain.where(F.col(at).isNotNull()), names[docs.columns.index(text)])

    def matching(kept: DataFrame) -> DataFrame:
        same = (digested[at].cast("long") == kept["kept_id"]) & (digested["digest"] == kept["kept_digest"])
        return digested.join(kept, same, "left_semi")

    # only rows that repeat need to be told apart; all others are filtered where they are read
    identified = matching(chosen.where("n = 1")).select(*names)
    repeated = chosen.where("n > 1")
    if not repeated.isEmpty():
        once = matching(repeated).groupBy(at, "digest").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row"))
        identified = identified.unionByName(once.select("row.*"))
    return identified.unionByName(plain.where(F.col(at).isNull())).toDF(*docs.columns)
