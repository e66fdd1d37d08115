"""Many languages, and words of several languages in one text."""

import random

import pytest

from tidegrid.llm import language


def words_of(k, n, rng):
    """Words of invented language ``k``: all end in its own letters."""
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(3)) + chr(0x4E00 + k) * 2 for _ in range(n))


def learned(spark, languages, each, words):
    rng = random.Random(1)
    rows = [(k * each + i, words_of(k, words, rng), f"l{k:02}") for k in range(languages) for i in range(each)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, language.learn(docs)


def test_every_language_has_a_place(spark):
    docs, model = learned(spark, 70, 12, 40)
    assert model.languages == [f"l{k:02}" for k in range(70)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert len({got[r["doc_id"]] for r in docs.collect() if got[r["doc_id"]] == r["lang"]}) == 70


def test_words_of_three_languages_are_labelled_and_kept(spark):
    _, model = learned(spark, 4, 40, 60)
    rng = random.Random(2)
    mixed = " ".join(words_of(k, 30, rng) for k in (0, 1, 2, 3))
    docs = spark.createDataFrame([(1, mixed), (2, None), (3, words_of(2, 5, rng)), (4, "12 !")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert [(s["first_word"], s["n_words"], s["lang"]) for s in got[1]["spans"]] == [(0, 30, "l00"), (30, 30, "l01"), (60, 30, "l02"), (90, 30, "l03")]
    assert got[1]["score"] < 0.35 < 0.8 < got[1]["certainty"]
    assert [s["lang"] for s in got[3]["spans"]] == ["l02"] and got[2]["spans"] == got[4]["spans"] == []
    assert got[1]["certainty"] == pytest.approx(sum(s["n_words"] * s["posterior"] for s in got[1]["spans"]) / 120)
    assert sorted(r["doc_id"] for r in language.keep_identified(docs, model).collect()) == [1, 3]
