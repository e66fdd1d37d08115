"""A Merkle manifest of a dataset: content-addressed trees, and membership proofs read by descending them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import checkpoint, numbered, pick, small_side

FANOUT = 2
#: Levels of the tree that one row of the record store spans, and so many leaves below it.
LEVELS = 10
SPAN = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A table of one row per lang is broadcast up to so many rows, and shuffled beyond.
BROADCAST_ROWS = 50_000
#: Requests that one copy of a record serves; a record that more requests name is copied.
SERVED = 16

_RECORDS = "array<struct<digest: binary, children: array<binary>>>"


def leaf_digest(values: list[Column]) -> Column:
    """H over the fields in order: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, values)), 256))


def with_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, lang, leaf, changed): the leaf's digest, and where ``tampered`` holds that with n_chars + 1."""
    plain = pick(docs, *FIELDS)
    values = [F.col(c) for c in FIELDS]
    changed = [F.try_add(v, F.lit(1)) if c == "n_chars" else v for c, v in zip(FIELDS, values)]
    return plain.select("doc_id", "lang", leaf_digest(values).alias("leaf"), F.when(tampered, leaf_digest(changed)).alias("changed"))


def _digest(children: list[bytes]) -> bytes:
    """H of nodes given and returned as lowercase hex."""
    return hashlib.sha256(b"".join(children)).hexdigest().encode()


def raise_block(leaves: list[bytes], alone: bool) -> tuple[bytes, list[tuple[bytes, list[bytes]]]]:
    """The root over consecutive nodes (hex) and the records (digest, children) of all nodes above them. A block that is
    a whole tree ends at one node; one of several goes up ``LEVELS`` levels, a last lone node becoming its H."""
    records, level, nodes = [], 0, leaves
    while len(nodes) > 1 or (not alone and level < LEVELS):
        runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
        nodes = [_digest(r) for r in runs]
        records += zip(nodes, runs)
        level += 1
    return nodes[0], records


def _raised(nodes: DataFrame) -> DataFrame:
    """(tree, block, total, digest, records) of blocks of ``SPAN`` nodes (tree, pos, total, digest)."""
    held = F.sort_array(F.collect_list(F.struct("pos", "digest")))
    blocks = nodes.groupBy("tree", F.floor(F.col("pos") / SPAN).alias("block"), "total").agg(F.transform(held, lambda x: x["digest"]).alias("digests"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, stores = [], []
            for total, digests in zip(batch.column("total").to_pylist(), batch.column("digests").to_pylist()):
                root, records = raise_block([d.hex().encode() for d in digests], total <= SPAN)
                roots.append(bytes.fromhex(root.decode()))
                stores.append([{"digest": bytes.fromhex(d.decode()), "children": [bytes.fromhex(c.decode()) for c in cs]} for d, cs in records])
            kind = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))
            columns = [*(batch.column(c) for c in ("tree", "block", "total")), pa.array(roots, pa.binary()), pa.array(stores, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "total", "digest", "records"])

    return blocks.mapInArrow(run, f"tree long, block long, total long, digest binary, records {_RECORDS}")


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The record stores of all trees over leaves (tree, pos, total, digest), the lowest first, and
    (tree, digest) of their roots. Each store spans ``LEVELS`` levels; a tree that ended earlier is passed on."""
    stores = []
    while True:
        store = checkpoint(_raised(nodes))
        stores.append(store)
        most = store.agg(F.max("total")).first()[0]
        if most is None or most <= SPAN:
            return stores, store.select("tree", "digest")
        nodes = store.select("tree", F.col("block").alias("pos"), F.ceil(F.col("total") / SPAN).alias("total"), "digest")


def descend(root: bytes, records: dict[bytes, list[bytes]], path: tuple) -> list[tuple[bytes, tuple]]:
    """The leaves below ``root`` in order of rank, each with its path from the tree's root: (digit, unselected
    children) of every level. Ranks that share leading digits share the walk."""
    out, stack = [], [(root, path)]
    while stack:
        node, walked = stack.pop()
        children = records.get(node)
        if children is None:
            out.append((node, walked))
            continue
        for digit in range(len(children) - 1, -1, -1):
            stack.append((children[digit], (*walked, (digit, children[:digit] + children[digit + 1 :]))))
    return out


def fold(leaf: bytes, path: tuple) -> bytes:
    """The root that a leaf and the siblings on its path give, from the last segment to the first."""
    for digit, siblings in reversed(path):
        leaf = _digest([*siblings[:digit], leaf, *siblings[digit:]])
    return leaf


def proof_digest(path: tuple) -> str:
    return hashlib.sha256(b"".join(s for _, siblings in reversed(path) for s in siblings)).hexdigest()


def _unpack(path: list[bytes]) -> tuple:
    return tuple((p[0], [p[i : i + 32].hex().encode() for i in range(1, len(p), 32)]) for p in path)


def _pack(path: tuple) -> list[bytes]:
    return [bytes([digit]) + b"".join(bytes.fromhex(s.decode()) for s in siblings) for digit, siblings in path]


def _loaded(records: list[dict]) -> dict[bytes, list[bytes]]:
    return {r["digest"].hex().encode(): [c.hex().encode() for c in r["children"]] for r in records}


def _served(requests: DataFrame, store: DataFrame) -> DataFrame:
    """``requests`` (block, digest, ...) with the ``records`` that their digest names. Equal trees are one record,
    so a digest that many requests name gets as many copies of it as keep a task small."""
    often = checkpoint(requests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SERVED).select("digest", F.ceil(F.col("n") / SERVED).alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    held = store.select("digest", "records").dropDuplicates(["digest"]).join(often, "digest", "left")
    dealt = held.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("copies")
    asked = requests.join(often, "digest", "left").withColumn("copy", F.pmod(F.xxhash64("tree", "block"), copies)).drop("copies")
    return asked.join(dealt, ["digest", "copy"]).drop("copy")


_REQUEST = "tree long, block long, digest binary, subroot binary, root binary, path array<binary>"


def _down(requests: DataFrame, store: DataFrame) -> DataFrame:
    """The requests one store lower: a block's request becomes one for each node that it spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = descend(row["digest"].hex().encode(), _loaded(row["records"]), _unpack(row["path"]))
                n = len(found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([row["tree"]] * n, pa.int64()), "block": pa.array([row["block"] * SPAN + i for i in range(n)], pa.int64()),
                        "digest": pa.array([bytes.fromhex(d.decode()) for d, _ in found], pa.binary()), "subroot": pa.array([row["subroot"]] * n, pa.binary()),
                        "root": pa.array([row["root"]] * n, pa.binary()), "path": pa.array([_pack(p) for _, p in found], pa.list_(pa.binary())),
                    }
                )

    return _served(requests, store).select("tree", "block", "digest", "subroot", "root", "path", "records").mapInArrow(run, _REQUEST)


def _proved(requests: DataFrame, store: DataFrame, members: DataFrame) -> DataFrame:
    """The last step down: every leaf of the lowest blocks with its proof's digest and the root folded from it."""
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = descend(row["digest"].hex().encode(), _loaded(row["records"]), _unpack(row["path"]))
                subroot, root = row["subroot"].hex(), row["root"].hex()
                rows = []
                for (node, path), m in zip(found, row["members"], strict=True):
                    folded = fold((m["changed"] or m["leaf"]).hex().encode(), path).decode()
                    rows.append((m["doc_id"], node.decode(), subroot, root, proof_digest(path), folded, folded == root))
                names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                yield pa.RecordBatch.from_arrays([pa.array(c) if n != "doc_id" else pa.array(c, pa.int64()) for n, c in zip(names, zip(*rows))], names)

    joined = _served(requests, store).join(members, ["tree", "block"])
    return joined.select("digest", "subroot", "root", "path", "records", "members").mapInArrow(run, schema)


def prove(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    Leaves are H of the row's fields; per lang, in order of doc_id, runs of two nodes become their H (a last lone
    one too) until one is left; the langs' subroots, null first, then by UTF-8 bytes, give the root likewise.
    ``tampered`` marks rows (default: none) whose n_chars is changed after the tree was built.

    Trees are kept as records, digest to children, in rows that span ``LEVELS`` levels: a store row is the part
    of a tree below one node and is found by that node's digest. Requests for all leaves go down from the root, store by store, by
    the digits of their rank, and collect the children not selected; requests with common leading digits go as one
    until they part. The segments of a path, reversed, are the proof, which is folded with the row's present leaf.
    Work is linear in the rows; a shuffle deals ``LEVELS`` levels, and no row holds more than ``SPAN`` leaves.

    Null fields count as ``-``; rows without id come first in their lang and aren't tampered by an id rule. Equal
    ids are ordered by leaf; repeated rows are leaves of their own (with equal leaf, proofs by their place). Texts are
    hashed where they are read and never shuffled, whatever their length. Other columns don't matter. An empty table gives no rows.
    """
    rows = checkpoint(with_leaves(docs, F.lit(False) if tampered is None else tampered))
    langs = checkpoint(numbered(rows.select("lang").distinct().withColumn("all", F.lit(0)), "all", ["lang"]).select(F.col("lang").alias("of"), F.col("pos").alias("tree"), F.col("total").alias("n_trees")))
    placed = numbered(rows.withColumn("doc_id", F.col("doc_id").cast("long")), "lang", ["doc_id", "leaf"])
    leaves = checkpoint(placed.join(small_side(langs, BROADCAST_ROWS), F.col("lang").eqNullSafe(F.col("of"))).select("tree", "pos", "total", "doc_id", F.col("leaf").alias("digest"), "changed"))
    stores, subroots = build(leaves.select("tree", "pos", "total", "digest"))
    top = subroots.join(small_side(langs, BROADCAST_ROWS), "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("n_trees").alias("total"), "digest")
    top_stores, roots = build(top)
    requests = roots.select("tree", F.lit(0).cast("long").alias("block"), "digest", F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast("array<binary>").alias("path"))
    for store in reversed(top_stores):
        requests = checkpoint(_down(requests, store))
    requests = requests.select(F.col("block").alias("tree"), F.lit(0).cast("long").alias("block"), "digest", F.col("digest").alias("subroot"), "root", "path")
    for store in reversed(stores[1:]):
        requests = checkpoint(_down(requests, store))
    member = F.struct("pos", "doc_id", F.col("digest").alias("leaf"), "changed")
    members = leaves.groupBy("tree", F.floor(F.col("pos") / SPAN).alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    return _proved(requests, stores[0], members)
