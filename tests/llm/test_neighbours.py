"""Blocks of neighbours under far-apart, repeated and missing ids."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import fingerprints

TOP = (1 << 63) - 1


@pytest.mark.parametrize("block_rows", [8, 2048])
def test_next_is_the_next_row_whatever_the_ids(spark, monkeypatch, block_rows):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", block_rows)
    rows = [(i, f"dense {i}") for i in range(100)] + [(1 << 40, "far"), (TOP, "last"), (-TOP - 1, "first")]
    rows += [(50, f"hot {i}") for i in range(60)] + [(None, f"none {i}") for i in range(40)] + [(None, None)] * 30 + [(7, "same")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    want = Counter((a["doc_id"], a["text"], b["text"]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    got = fingerprints.with_next(docs)
    assert Counter((r["doc_id"], r["text"], r["next"]["text"]) for r in got.select("doc_id", "text", "next").collect()) == want
    wrong = got.where((F.col("own") != fingerprints.paragraph_digests(F.col("text"))) | (F.col("next.own") != fingerprints.paragraph_digests(F.col("next.text"))))
    assert wrong.isEmpty()


def test_no_block_is_large(spark):
    ids = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    docs = ids.unionByName(spark.createDataFrame([(1 << 40, "far")], "doc_id long, text string"))
    seen = []
    real = fingerprints._block_of

    def block_of(place, cuts):
        seen.append(cuts)
        return real(place, cuts)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(fingerprints, "_block_of", block_of)
        fingerprints.with_next(docs)
    blocks = docs.select(real(fingerprints._place(F.col("doc_id"), F.xxhash64("text")), seen[0])["block"].alias("b")).groupBy("b").count().collect()
    assert max(r["count"] for r in blocks) < 2 * fingerprints.BLOCK_ROWS and min(r["b"] for r in blocks) == 1
