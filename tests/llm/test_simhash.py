import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm import simhash


def plain_fingerprint(text):
    """The definition, word by word."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def least_reachable(values, least, budget):
    """value -> least id over all values that links of at most ``budget`` bits reach."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, v in enumerate(values):
        for w in values[:i]:
            if (v ^ w).bit_count() <= budget:
                x, y = sorted((find(v), find(w)))
                root[y] = x
    out = {}
    for v in values:
        out[find(v)] = min(out.get(find(v), least[v]), least[v])
    return {v: out[find(v)] for v in values}


def clustered(rng, n):
    """Values in balls of near ones, some at the edge of the budget, some with a common upper half."""
    base = [int(x) for x in rng.integers(0, 1 << 63, n, dtype=np.uint64)]
    out = set(base)
    for b in base[: n // 2]:
        for k in range(1, 5):
            flips = rng.choice(64, k, replace=False)
            out.add(b ^ sum(1 << int(f) for f in flips))
    out |= {(base[0] >> 32 << 32) ^ i for i in range(40)}
    return sorted(out)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_join_links_what_all_pairs_link(budget, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 64)  # so that pairs wait in many pieces
    values = clustered(np.random.default_rng(budget), 60)
    least = {v: i for i, v in enumerate(values)}
    array = np.array(values, np.uint64)
    for cut in (0, len(array) // 3):
        if cut:
            parts = [simhash.trie_links(array[:cut], None, budget), simhash.trie_links(array[cut:], None, budget), simhash.trie_links(array[:cut], array[cut:], budget)]
        else:
            parts = [simhash.trie_links(array, None, budget)]
        edges = [(int(x), int(y)) for p in parts for x, y in zip(*p)]
        root = {v: v for v in values}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for x, y in edges:
            a, b = sorted((find(x), find(y)))
            root[b] = a
        got = {}
        for v in values:
            got[find(v)] = min(got.get(find(v), least[v]), least[v])
        assert {v: got[find(v)] for v in values} == least_reachable(values, least, budget)


@pytest.mark.parametrize("leaf", [3, 30, 4096])
def test_links_over_an_upper_trie_of_any_depth(spark, leaf):
    values = clustered(np.random.default_rng(9), 40)
    least = {v: i for i, v in enumerate(values)}
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    joined = {r["node"]: r["root"] for r in simhash.components(simhash._links(fps, 2, leaf)).collect()}
    sign = lambda v: v - (1 << 64) if v >> 63 else v
    groups = {}
    for v in values:
        groups.setdefault(joined.get(sign(v), sign(v)), []).append(least[v])
    want = least_reachable(values, least, 2)
    assert {v: min(groups[joined.get(sign(v), sign(v))]) for v in values} == want


def test_long_texts_are_hashed_in_windows(monkeypatch, odd_texts):
    monkeypatch.setattr(simhash, "WINDOW_BYTES", 50)
    for text in odd_texts:
        assert simhash.simhash((text or "").encode()) == plain_fingerprint(text)


def check(out, texts):
    """``out`` (doc_id, fingerprint, component_id) against all pairs."""
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    values = sorted(set(fps.values()))
    least = {v: min(i for i in fps if fps[i] == v) for v in values}
    want = least_reachable(values, least, 2)
    known = [r for r in out if r["doc_id"] is not None]
    assert {r["doc_id"] for r in known} == set(texts)
    for r in known:
        assert (r["fingerprint"], r["component_id"]) == (f"{fps[r['doc_id']]:016x}", want[fps[r["doc_id"]]])


def test_query_over_all_documents(spark, small, small_docs):
    from tidegrid.llm.queries import QUERIES

    out = QUERIES["op13_simhash_trie"](spark, small).collect()
    check(out, {r["doc_id"]: r["text"] for r in small_docs.select("doc_id", "text").collect()})
    assert len({r["component_id"] for r in out}) < len(out)


def test_odd_rows(odd_docs, odd_texts, no_docs):
    out = simhash.near_duplicates(odd_docs).collect()
    assert len(out) == len(odd_texts) + 2
    check(out, dict(enumerate(odd_texts)))
    [alone] = [r for r in out if r["doc_id"] is None]
    twin = next(r for r in out if r["doc_id"] == 6)
    assert (alone["fingerprint"], alone["component_id"]) == (twin["fingerprint"], twin["component_id"])
    assert simhash.near_duplicates(no_docs).collect() == []


def test_a_value_of_a_third_of_the_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same three words and more").otherwise(F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256), F.lit(" end"))).alias("text")
    )
    out = simhash.near_duplicates(docs)
    assert out.count() == 3000 and out.where("doc_id % 3 = 0 and component_id <> 0").isEmpty()
