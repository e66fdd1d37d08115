import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import manifest

FIELDS = manifest.FIELDS


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row[c] if c != "n_chars" or row[c] is None else row[c] + more for c in FIELDS]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root and, per node, its path of (digit, siblings) from the bottom up."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for digit, _ in enumerate(run):
                for leaf in owners[i + digit]:
                    paths[leaf].append((digit, run[:digit] + run[digit + 1 :]))
            above.append(H(*run))
            held.append([x for o in owners[i : i + 2] for x in o])
        nodes, owners = above, held
    return nodes[0], paths


def brute(rows, tampered):
    """Sorted result tuples of the definition."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))) for lang in langs]
    trees = [tree([leaf_of(r) for r in g]) for g in groups]
    root, top = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), above in zip(groups, trees, top):
        for r, path in zip(g, paths):
            path = path + above
            now = leaf_of(r, 1 if tampered(r) else 0)
            for digit, siblings in path:
                now = H(*siblings[:digit], now, *siblings[digit:])
            proof = H(*(s for _, siblings in path for s in siblings))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def by_seven(r):
    return r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0


RULE = "crc32(cast(cast(doc_id as string) as binary)) % 7 = 0"


def rows_of(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_query_over_all_documents(spark, small, small_docs):
    from tidegrid.llm.queries import QUERIES

    out = rows_of(QUERIES["op12_merkle_manifest"](spark, small))
    rows = small_docs.collect()
    assert out == brute(rows, by_seven)
    changed = {r["doc_id"] for r in rows if by_seven(r) and r["n_chars"] is not None}
    assert {r[0] for r in out if not r[6]} == changed and changed


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_trees_over_several_stores(small_docs, levels, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "SPAN", 2**levels)
    for n in (1, 2, 5, 29):
        some = small_docs.where(F.col("doc_id") < n)
        assert rows_of(manifest.prove(some, F.expr(RULE))) == brute(some.collect(), by_seven)


def test_odd_rows(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(manifest, "SPAN", 4)
    monkeypatch.setattr(manifest, "LEVELS", 2)
    monkeypatch.setattr(manifest, "SERVED", 1)
    assert rows_of(manifest.prove(odd_docs, F.expr(RULE))) == brute(odd_docs.collect(), by_seven)
    assert all(r[6] for r in rows_of(manifest.prove(odd_docs)))
    assert manifest.prove(no_docs, F.expr(RULE)).collect() == []


def test_repeated_rows_share_records(spark, monkeypatch):
    monkeypatch.setattr(manifest, "SPAN", 4)
    monkeypatch.setattr(manifest, "LEVELS", 2)
    docs = spark.range(150).select(
        F.when(F.col("id") < 100, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.lit(3).cast("long").alias("n_chars"), F.lit("abc").alias("text"),
    )
    assert rows_of(manifest.prove(docs, F.expr(RULE))) == brute(docs.collect(), by_seven)


def test_every_lang_may_be_its_own(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("lang"), F.lit(None).cast("long").alias("n_chars"), F.lit("").alias("text")
    )
    assert rows_of(manifest.prove(docs, F.expr(RULE))) == brute(docs.collect(), by_seven)
