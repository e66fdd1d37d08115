"""Piece sampling, token files, token counts, language identification, near-dedup and the pipeline."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm import language, minhash, piece_sampling, token_counts, token_files
from tidegrid.llm.common import new_folder, pick
from tidegrid.llm.graph import components
from tidegrid.llm.lattice import Vocabulary

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_sampled_pieces_are_lossless_and_reproducible(odd_docs, no_docs):
    a = piece_sampling.sample_pieces(odd_docs, PIECES)
    rows = a.collect()
    assert all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in rows)
    again = piece_sampling.sample_pieces(odd_docs.repartition(3), PIECES).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    back = piece_sampling.decode_pieces(a, PIECES).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back) == sorted((r["doc_id"] or -1, r["text"] or "") for r in odd_docs.collect())
    assert piece_sampling.sample_pieces(no_docs, PIECES).count() == 0


def test_tables_dont_depend_on_what_is_learned_together(small_docs):
    v = Vocabulary.load(PIECES)
    alone, together = piece_sampling.Sampler(v, 0.5), piece_sampling.Sampler(v, 0.5)
    chunks = sorted({c for r in small_docs.select("text").limit(60).collect() for c in alone.chunks(" " + r["text"])})[:3000]
    together.learn(chunks)
    for at in range(0, len(chunks), 7):
        alone.learn(chunks[at : at + 7])

    def tables(s, chunk):
        k = s.place[chunk]
        edges = [s.first[i] for i in range(s.start[k] + 1, s.end[k] + 1)]
        return [(int(s.piece[e]), float(s.upto[e])) for first in edges for e in range(first, first + 1 + int(np.argmax(s.upto[first:] == 2.0)))]

    assert all(tables(alone, c) == tables(together, c) for c in chunks)


def _runs(n):
    letters = random.Random(3)
    return ["".join(letters.choices(alphabet, k=n)) for alphabet in ("etaoinshr", "abcdefghijklmnopqrstuvwxyz0123456789+/", "天地玄黄宇宙洪荒", "aé\u2581☃x")]


def test_long_chunks_in_windows_are_sampled_as_in_one_lattice(monkeypatch):
    v = Vocabulary.load(PIECES)
    texts = [*_runs(900), "short words stay " + _runs(700)[0] + " between others", "", "a b"]
    seeds = piece_sampling.row_seeds(list(range(len(texts))), 1)
    whole = piece_sampling.Sampler(v, 0.5).sample(texts, seeds)
    monkeypatch.setattr(piece_sampling, "LONG_CHUNK", 100)
    for window in (1 << 16, 64, 7):
        monkeypatch.setattr(piece_sampling, "WINDOW", window)
        monkeypatch.setattr(piece_sampling, "DRAWS", 50)
        sampler = piece_sampling.Sampler(v, 0.5)
        for _ in range(2):
            ids, count = sampler.sample(texts, seeds)
            assert count.tolist() == whole[1].tolist() and ids.tolist() == whole[0].tolist()
        assert max(map(len, sampler.place)) <= 100


def test_long_words_are_counted_as_in_one_lattice(monkeypatch):
    counter, words = token_counts.Counter(Vocabulary.load(PIECES)), ["▁" + w for n in (1, 50, 1500) for w in _runs(n)]
    together = counter(words)
    monkeypatch.setattr(token_counts, "LONG_WORD", 20)
    alone = counter(words)
    assert alone[0].tolist() == together[0].tolist() and alone[1].tolist() == together[1].tolist()


def test_memory_of_an_unbroken_run_is_that_of_a_window():
    """Three hundred thousand letters without a space: lossless, and no more memory than some windows take."""
    import tracemalloc

    v, run = Vocabulary.load(PIECES), _runs(300_000)[1]
    sampler, counter, decode = piece_sampling.Sampler(v, 0.5), token_counts.Counter(v), piece_sampling.Decoder(v)
    tracemalloc.start()
    ids, count = sampler.sample([run], piece_sampling.row_seeds([1], 0))
    sampled = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    found, _ = counter([run])
    counted = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert decode(ids) == run and count[0] == len(ids) >= found[0] > 0
    assert sampled < 120 << 20 and counted < 40 << 20


def test_samples_follow_the_lattice_distribution():
    v = Vocabulary.load(PIECES)
    sampler, n, word = piece_sampling.Sampler(v, 0.5), 60_000, "▁then"
    ids, count = sampler.sample(["then"] * n, piece_sampling.row_seeds(list(range(n)), 1))
    ends = np.cumsum(count)
    got = collections.Counter(tuple(v.pieces[i] for i in ids[e - c : e]) for e, c in zip(ends, count, strict=True))
    score = {p: s for p, s, c in zip(v.pieces, v.scores, v.control, strict=True) if not c}
    weight = {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        ps = tuple(word[i:j] for i, j in itertools.pairwise(at))
        if all(p in score for p in ps):
            weight[ps] = math.exp(0.5 * sum(score[p] for p in ps))
    total = sum(weight.values())
    assert set(got) <= set(weight)
    assert max(abs(got[k] / n - w / total) for k, w in weight.items()) < 0.01


def test_counts_are_the_tokenizers(odd_docs, no_docs, small_docs):
    from tokenizers import Tokenizer, models, pre_tokenizers

    v = Vocabulary.load(PIECES)
    exact = Tokenizer(models.Unigram(list(zip(v.pieces, v.scores.tolist(), strict=True)), unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    docs = pick(odd_docs, "doc_id", "text").where("doc_id is not null and doc_id <> 16").union(small_docs.select(F.col("doc_id") + 1000, "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in token_counts.count_tokens(docs, PIECES).collect():
        assert r["n_tokens"] == len(exact.encode(texts[r["doc_id"]], add_special_tokens=False).ids), texts[r["doc_id"]][:80]
    assert token_counts.count_tokens(no_docs, PIECES).count() == 0


def test_ties_go_to_the_longest_piece():
    v = Vocabulary(["<unk>", "a", "aa", "aaa", "▁"], np.array([-50.0, -1.0, -2.0, -3.0, 0.0]), np.arange(256), np.array([True, False, False, False, False]))
    count, best = token_counts.Counter(v)(["▁aaa", "▁aaaa", "▁ab"])
    assert count.tolist() == [2, 3, 3] and best[0] == -3.0 and best[2] == -61.0


def test_token_files_round_trip(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(WORDS)
    folder = new_folder(spark, "files")
    token_files.write_token_files(odd_docs, folder, WORDS)
    rows = token_files.read_token_files(spark, folder).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        ids = exact.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["start"] == at and r["n_tokens"] == len(ids)
        at += len(ids)
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order[0] is None and order[1:] == sorted(order[1:])
    files = [r["file"] for r in spark.read.parquet(f"{folder}/manifest").collect()]
    found = [x for f in files if (x := token_files.read_document(folder, f, 12))]
    assert found == [exact.encode(texts[12], add_special_tokens=False).ids + [1]]
    assert token_files.round_trip(no_docs, WORDS).count() == 0


def test_dictionary_sample_is_of_least_hash(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SAMPLE_DOCS", 20)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    hashed = docs.withColumn("h", F.xxhash64("doc_id", F.octet_length("text"))).where("h >= 0").orderBy("h").limit(20)
    some = token_files.sample_texts(docs, 3000)
    assert len(some) == 20 and len({t for t in some}) == 20
    assert len(token_files.sample_texts(docs.limit(7), 7)) == 7 and hashed.count() == 20
    repeated = docs.limit(5).crossJoin(spark.range(400).select()).select("doc_id", "text")
    assert len(token_files.sample_texts(repeated, 2000)) <= 5


def test_encoder_is_exact_on_adversarial_words():
    from tokenizers import Tokenizer

    exact, mine = Tokenizer.from_file(WORDS), token_files.Encoder(WORDS, 2)
    rng = random.Random(3)
    signs = ["a", "B", "é", "é", "'s", "'", ".", "!", "<|endoftext|>", "<|ENDOFTEXT|>", "9", " ", "\x1c", "\x85", " ", "\n", "日", "Σ", "İ", "#", "_", "́"]
    for _ in range(400):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 14)))
        assert np.frombuffer(mine.ids([text.encode()], b"")[0], "<u2").tolist() == exact.encode(text, add_special_tokens=False).ids, text


def test_language_on_held_out_and_odd_rows(spark, odd_docs, no_docs, small):
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    model = language.learn(docs)
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    odd = {r["doc_id"]: r for r in language.identify(odd_docs, model).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (0, 1, 2, 3, 17)) and len(odd) == 21
    assert language.identify(no_docs, language.learn(no_docs)).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd_docs, language.learn(no_docs)).collect()} == {"und"}
    assert language.keep_identified(odd_docs, model).columns == odd_docs.columns


def test_forward_backward_is_exact_and_switches():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4])
    emission, first, pair = rng.normal(size=(8, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    got, at = language.forward_backward(emission, lengths, first, pair), 0
    for n in lengths:
        weight = {}
        for path in itertools.product(range(2), repeat=n):
            score = first[path[0]] + sum(emission[at + t, y] for t, y in enumerate(path)) + sum(pair[a, b] for a, b in itertools.pairwise(path))
            weight[path] = math.exp(score)
        for t in range(n):
            want = sum(w for p, w in weight.items() if p[t] == 1) / sum(weight.values())
            assert abs(got[at + t, 1] - want) < 1e-9
        at += n


def test_words_of_a_code_switched_text_are_labelled():
    rng = random.Random(1)
    one, two = [f"{a}{b}ing" for a in "bcdf" for b in "aeiou"], [f"{a}{b}eux" for a in "lmnp" for b in "aeiou"]
    samples = [(l, [rng.choice(v) for _ in range(60)]) for _ in range(60) for l, v in (("x", one), ("y", two))]
    model = language.fit(samples, ["x", "y"])
    words = one[:8] + two[:8] + one[:4]
    post = language.forward_backward(model.emissions(words), np.array([len(words)]), model.first, model.pair)
    assert post.argmax(axis=1).tolist() == [0] * 8 + [1] * 8 + [0] * 4
    assert model.pair[0, 0] > model.pair[0, 1]


def brute_components(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def chained(spark, groups=6, copies=14):
    """Groups of near copies that drift apart, so that groups hang together by a chain of links."""
    rng, rows = random.Random(5), []
    for g in range(groups):
        words = [f"g{g}w{rng.randrange(400)}" for _ in range(120)]
        for c in range(copies):
            rows.append((len(rows), " ".join(words)))
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates(spark, odd_docs, no_docs, small_docs):
    for docs in (small_docs, chained(spark), odd_docs):
        want = brute_components(docs)
        got = [r for r in minhash.near_duplicates(docs).collect() if r["doc_id"] is not None]
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert minhash.near_duplicates(no_docs).count() == 0
    kept = minhash.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 6").count() == 1 and kept.where("doc_id in (7, 8, 9)").count() == 0


def test_blocks_split_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    docs = chained(spark, 2, 20)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()} == {d: c for d, (_, c) in brute_components(docs).items()}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (200, 200)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {95: 90, 100: 90}
    assert components(edges.limit(0)).count() == 0


@pytest.fixture(scope="module")
def labels(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(10, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_stages(spark, odd_docs, no_docs, labels):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, labels)
            if name != "encode":
                assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.columns == ["doc_id", "n_pieces", "pieces", "lossless"] and docs.where("not lossless").count() == 0


def test_pipeline_keeps_what_each_operator_says(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "near_dedup", "mix_sources", "encode"]
    out = corpus_pipeline.run(spark, small)
    assert out.where("not lossless").count() == 0
    verdicts = {r["doc_id"]: r["kept"] for r in __import__("tidegrid.llm.queries", fromlist=["QUERIES"]).QUERIES["op10_quality_rules"](spark, small).collect()}
    clean = docs.where(F.col("doc_id").isin([d for d, k in verdicts.items() if k]))
    roots = {c for _, c in brute_components(clean).values()}
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} <= roots
