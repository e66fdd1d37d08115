import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import importance

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, most=1):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, most=1):
    """[(doc_id, n_features, weight, score, rank)] of the definition, for (doc_id, text) rows."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    held = [(i, *features(t, most)) for i, t in rows]
    raw = Counter(bucket(f) for _, _, fs in held for f in fs)
    want = Counter(bucket(f) for t in target for f in features(t, most)[1])
    S, T = sum(raw.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (S + 10000) / ((raw[b] + 1) * (T + 10000))))
    out = []
    for i, n, fs in held:
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((o for o in out if o[1] >= 20), key=lambda o: (-o[4], o[0] is None, o[0] or 0, o[2]))
    drawn = 10 * len(order) // 100
    ranked = [(i, k, w, s, r) for r, (i, _, k, w, s) in enumerate(order[:drawn], 1)]
    left = order[drawn:] + [o for o in out if o[1] < 20]
    return sorted([*ranked, *((i, k, w, s, None) for i, _, k, w, s in left)], key=str)


def rows_of(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("finish", [1, 4096])
def test_query_over_all_documents(spark, small, small_docs, finish, monkeypatch):
    from tidegrid.llm.queries import QUERIES

    monkeypatch.setattr(importance, "FINISH", finish)
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = brute([(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()], target)
    assert rows_of(QUERIES["op11_importance_sample"](spark, small)) == want
    assert any(r[4] for r in want)


def test_runs_of_words_in_windows(small_docs, monkeypatch):
    memo = importance._memo()
    for window in (7, 1 << 20):
        monkeypatch.setattr(importance, "WINDOW_BYTES", window)
        for r in small_docs.limit(20).collect():
            n, buckets = importance.feature_buckets(r["text"].encode(), memo, 3)
            want = features(r["text"], 3)
            assert n == want[0] and Counter(buckets.tolist()) == Counter(zlib.crc32(f.encode()) % 10000 for f in want[1])


def test_selection_finds_every_key(spark, monkeypatch):
    monkeypatch.setattr(importance, "FINISH", 3)
    rows = spark.range(0, 400, 1, 7).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.hash("id") % 40).cast("long").alias("score"), F.lit(1).cast("long").alias("n_features"))
    keyed = importance.checkpoint(importance.with_key(rows))
    order = sorted(tuple(r) for r in keyed.select(*importance.KEY).collect())
    for nth in (1, 2, 137, 399, 400):
        assert importance.nth_key(keyed, nth) == order[nth - 1]


def test_repeated_rows_and_ties(spark, monkeypatch):
    monkeypatch.setattr(importance, "FINISH", 2)
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, text)] * 30 + [(i, f"{text} {i % 5}") for i in range(2, 60)] + [(None, text)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("w1 w2 3",)], "text string")
    assert rows_of(importance.resample(docs, target)) == brute(rows, ["w1 w2 3"])


def test_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(None, 1), ("alpha stone", 2), ("", 3)], "text string, Text int")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(importance.resample(odd_docs, target)) == brute(rows, ["alpha stone"])
    assert importance.resample(no_docs, target).collect() == []
    assert all(r[4] is None for r in rows_of(importance.resample(odd_docs.limit(3), no_docs)))
