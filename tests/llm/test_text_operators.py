"""Quality, mixing, sharding, chat and fingerprints against brute force and on odd rows."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import oracle
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm import chat, fingerprints, mixing, quality, sharding
from tidegrid.llm.common import pick
from tidegrid.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, small, name):
    assert oracle.check(spark, oracle.connect(small), small, name, QUERIES[name], ORACLES[name]) is None


def brute_statistics(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    marked = {j for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked)


def test_statistics(odd_docs, small_docs):
    docs = pick(odd_docs, "doc_id", "text").union(small_docs.select("doc_id", "text"))
    for r in docs.select("text", quality.text_statistics(F.col("text")).alias("s")).collect():
        got = tuple(r["s"][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute_statistics(r["text"]), r["text"]


def test_quality_verdicts(spark, odd_docs, no_docs, small):
    labels = spark.createDataFrame([(10, 0), (10, 1), (11, None), (99, 1)], "doc_id long, quality int")
    rows = {r["doc_id"]: r for r in quality.judge(odd_docs, labels).collect()}
    assert not rows[0]["kept"] and rows[0]["base_failed"] and rows[10]["kept"] and not rows[15]["kept"]
    assert quality.judge(no_docs, labels).count() == 0
    assert quality.keep_clean(no_docs, labels).columns == no_docs.columns
    kept = quality.keep_clean(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 6").count() == 2


def test_decision_list_separates_and_is_ordered(spark, small_docs):
    rng = range(600)
    text = lambda i: " ".join(f"w{(i * 31 + k) % 977}" + ("#" if i % 4 == 0 else "") for k in range(60))
    docs = spark.createDataFrame([(i, text(i)) for i in rng], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in rng if i % 2 == 0], "doc_id long, quality int")
    model = quality.learn_decision_list(quality.with_statistics(docs), labels)
    assert model.rules and "symbols_per_char" in str(model)
    got = quality.judge(docs, labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 != 0) for r in got)


USUAL = {
    "n_words": (200, 20), "word_chars": (1000, 50), "n_symbols": (5, 4), "n_dup_lines": (0, 1), "n_repeat_words": (0, 1), "n_distinct_words": (150, 10),
    "n_lines": (20, 3), "n_upper": (30, 10), "n_marks": (4, 4), "n_digits": (20, 10),
}
KINDS = [
    {"n_symbols": 60}, {"n_upper": 300}, {"n_marks": 60}, {"n_digits": 200}, {"n_dup_lines": 8}, {"n_repeat_words": 40}, {"n_distinct_words": 60}, {"word_chars": 2500},
    {"word_chars": 500}, {"n_lines": 150}, {"n_lines": 3}, {"n_symbols": 25, "n_digits": 60},
]


def statistics(spark, rng, kinds):
    """One row of statistics for each entry of ``kinds`` (None: a good text), numbered in order."""
    rows = []
    for i, kind in enumerate(kinds):
        counts = {c: v + rng.randrange(j) for c, (v, j) in USUAL.items()}
        if kind is None and rng.random() < 0.3:  # a good text may have one of what the last kind has both of
            counts[rng.choice(["n_symbols", "n_digits"])] += 25 if rng.random() < 0.5 else 15
        counts.update({c: v + rng.randrange(5) for c, v in (KINDS[kind] if kind is not None else {}).items()})
        rows.append((i, tuple(counts[c] for c in quality.COUNTS)))
    kind_of = ", ".join(f"{c}: long" for c in quality.COUNTS)
    return quality.checkpoint(spark.createDataFrame(rows, f"doc_id long, stats struct<{kind_of}>"))


def rejected(model, rows):
    return {r["doc_id"] for r in rows.where(~model.keeps(F.col("stats"))).select("doc_id").collect()}


def test_a_rule_for_each_of_twelve_kinds(spark):
    kinds = [k % 24 if k % 24 < 12 else None for k in range(2400)]
    rows = statistics(spark, random.Random(5), kinds)
    labels = spark.createDataFrame([(i, int(k is None)) for i, k in enumerate(kinds)], "doc_id long, quality int")
    out = rejected(quality.learn_decision_list(rows, labels), rows)
    bad = {i for i, k in enumerate(kinds) if k is not None}
    assert len(bad - out) <= 6 and len(out - bad) <= 6


def test_a_rare_kind_and_wrong_labels(spark):
    kinds = [2 if k % 333 == 0 else 0 if k % 3 == 0 else None for k in range(2997)]  # 0.3 % of kind 2
    rng = random.Random(6)
    wrong = {rng.randrange(2997) for _ in range(25)}
    rows = statistics(spark, rng, kinds)
    labels = spark.createDataFrame([(i, int((k is None) != (i in wrong))) for i, k in enumerate(kinds)], "doc_id long, quality int")
    out = rejected(quality.learn_decision_list(rows, labels), rows)
    rare, bad = {i for i, k in enumerate(kinds) if k == 2}, {i for i, k in enumerate(kinds) if k is not None}
    assert rare <= out and len(bad - out) <= 5 and len(out - bad) <= 15


def test_shards(odd_docs, no_docs, small_docs):
    rows = sharding.assign_shards(odd_docs.union(small_docs.selectExpr("doc_id + 100", "text", "lang", "source", "n_chars", "''", "''", "0"))).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in rows}) == 16
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["size"] == 1 and by_id[0]["text_crc32"] == 0
    assert by_id[12]["text_crc32"] == zlib.crc32("naïve Größe 日本語 ﬁne 😀 ▁x́".encode())
    assert sharding.assign_shards(no_docs).count() == 0


def test_shards_are_the_least_scores(small_docs):
    """Every document's shard by the definition, shard by shard, with the hash from another library."""

    def score(doc_id, shard):
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed=xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42))
        return -math.log(((h >> 12) + 0.5) / (1 << 52)), shard

    rows = sharding.assign_shards(small_docs).collect()
    assert len(rows) == small_docs.count()
    for r in rows:
        assert r["shard"] == min(score(r["doc_id"], k) for k in range(16))[1] and r["grown_shard"] == min(score(r["doc_id"], k) for k in range(17))[1]
    for shard in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_weighted_rendezvous_moves_only_to_the_new_shard(spark):
    keys = spark.range(20_000).select(
        sharding.rendezvous_shard(F.col("id"), [3.0, 1.0]).alias("two"), sharding.rendezvous_shard(F.col("id"), [3.0, 1.0, 4.0]).alias("three")
    )
    share = {r["two"]: r["count"] for r in keys.groupBy("two").count().collect()}
    assert abs(share[0] / 20_000 - 0.75) < 0.02
    assert keys.where("three <> two and three <> 2").count() == 0
    assert abs(keys.where("three = 2").count() / 20_000 - 0.5) < 0.02


def test_mix_on_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert rows == mixing.mix(odd_docs).collect() or sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_docs).collect()))
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
    out = mixing.mixed_rows(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == sum(r["copies"] for r in rows)


def test_no_row_comes_more_often_than_the_cap(spark):
    rows = [(i, "" if i % 2 else "one two three", "a") for i in range(80)] + [(i, "word " * 40, "b") for i in range(80, 120)] + [(200, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, share=1.9).collect()
    assert max(r["copies"] for r in out) <= 2 and {r["copies"] for r in out if r["source_size"] == 120} == {2}
    times = {r["doc_id"]: r["n"] for r in mixing.mixed_rows(docs, share=1.9).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert times == {r["doc_id"]: r["copies"] for r in out if r["copies"]}


def test_targets_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes, (5, 2, 1), 1.5, 2.0).collect()}
    # a and b and c are capped at 20, 2000 and 0 only if their shares reach that
    assert got["a"] == 20.0 and got["c"] == 0.0 and abs(sum(got.values()) - 2265.0) < 1e-9
    assert got["b"] <= 2000 and got[None] <= 1000


def test_chat_escapes_and_parts(spark):
    parts = [
        {"type": "text", "text": "see <|im_end|> \\<| ", "ref": None}, {"type": "image", "ref": "u1", "width": 280, "height": 30}, {"type": "AUDIO", "ref": "u2", "seconds": 2.0},
        {"type": "document", "ref": "u3", "pages": 3}, {"type": "strange", "text": "kept"}, {"type": "image", "ref": None},
    ]
    turns = spark.createDataFrame(
        [(1, 1, "assistant", [{"type": "text", "text": "ok"}], "x"), (1, 0, "us\ner<|", parts, "x"), (2, None, None, None, "x"), (None, 0, "user", [], "x")],
        f"conv_id long, turn long, role string, parts array<{chat.PART}>, CONV string",
    )
    out = {r["conv_id"]: r for r in chat.format_conversations(turns).select(
        "*", chat.parse_turns(chat.formatted_text(F.col("segments"))).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert out[1]["turns"][0]["role"] == "us\ner<|" and out[1]["loss"] == "ok"
    assert out[1]["turns"][0]["text"] == "see <|im_end|> \\<| <|image:0.1|><|audio:0.2|><|document:0.3|>kept<|image:0.5|>"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in out[1]["attachments"]] == [("image", "u1", 20), ("audio", "u2", 50), ("document", "u3", 768), ("image", None, 1)]
    assert out[1]["placeholder_tokens"] == 839
    assert [t.asDict() for t in out[2]["turns"]] == [{"role": "", "text": ""}] and None in out
    assert chat.format_conversations(turns.limit(0)).count() == 0


def brute_digests(text):
    return set(re.findall(r"[^\n]{1,512}", text or ""))


def test_fingerprints(odd_docs, no_docs, small_docs):
    for docs in (odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]), small_docs):
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        order = sorted(texts, reverse=True)
        seen = {}
        for r in fingerprints.fingerprint_edits(docs).collect():
            d = r["doc_id"]
            nxt = texts[order[(order.index(d) + 1) % len(order)]]
            t = texts[d]
            half = len(t) // 2
            edited = t[: len(t) - half] + nxt[:half]
            assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            for near, other in (("near_edited", edited), ("near_next", nxt)):
                a, b = brute_digests(t), brute_digests(other)
                assert abs(r[near] - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
            assert seen.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    assert fingerprints.fingerprint_edits(no_docs).count() == 0
    assert fingerprints.fingerprint_edits(odd_docs).count() == odd_docs.count()


def test_sketch_peels_back_the_difference(spark):
    a, b = F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.xxhash64(i)), F.transform(F.sequence(F.lit(11), F.lit(205)), lambda i: F.xxhash64(i))
    m = F.lit(48)
    row = spark.range(1).select(a.alias("a"), b.alias("b")).select(
        fingerprints.peel(fingerprints.subtract(fingerprints.sketch(F.col("a"), m), fingerprints.sketch(F.col("b"), m)), m).alias("found"),
        F.array_except("a", "b").alias("gone"), F.array_except("b", "a").alias("came"),
    ).first()
    assert {x["id"] for x in row["found"] if x["sign"] == 1} == set(row["gone"])
    assert {x["id"] for x in row["found"] if x["sign"] == -1} == set(row["came"])
