"""Components against a plain union-find, and what bounds the language model's table of words."""

import random

import pytest

from tidegrid.llm import graph, language


def plain_components(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


@pytest.mark.parametrize("most", [3, 200_000])
def test_components_of_any_size(spark, monkeypatch, most):
    """Graphs beyond ``LOCAL_EDGES`` go through stars, blocks of few edges among them; smaller ones are done at once."""
    monkeypatch.setattr(graph, "LOCAL_EDGES", most)
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(-30, 30)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(220)] + [(500, 500), (-(1 << 62), 1 << 62)]
    frame = spark.createDataFrame(edges * 2, "a long, b long").repartition(5)
    got = {r["node"]: r["root"] for r in graph.components(frame).collect()}
    assert got == plain_components([e for e in edges if e[0] != e[1]])
    assert graph.components(frame.limit(0)).count() == 0


def test_small_graph_takes_no_rounds(spark, monkeypatch):
    def stars(*_):
        raise AssertionError("a small graph was shuffled")

    monkeypatch.setattr(graph, "_stars", stars)
    frame = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(4)
    assert {r["root"] for r in graph.components(frame).collect()} == {0}


def test_word_table_is_bounded_by_words(monkeypatch):
    """With few languages the table was bounded by 300,000 * 64 numbers only: millions of words, and all new ones at once."""
    samples = [("aa", ["ala", "bala", "gala"] * 20), ("bb", ["oro", "boro", "doro"] * 20)] * 6
    model = language.fit(samples, ["aa", "bb"])
    texts = [" ".join(chr(97 + (i * 7 + j) % 26) + "xyzq"[j % 4] + chr(97 + j % 26) * (i % 5) for j in range(40)) for i in range(60)]
    whole = language.Predictor(model)(texts)
    most, emissions = [], model.emissions
    monkeypatch.setattr(language, "TABLE_WORDS", 50)
    monkeypatch.setattr(language, "NEW_WORDS", 7)
    monkeypatch.setattr(model, "emissions", lambda ws: most.append(len(ws)) or emissions(ws), raising=False)
    predict = language.Predictor(model)
    for i, text in enumerate(texts):
        said = predict([text])
        assert said.languages[0] == whole.languages[i] and abs(said.scores[0] - whole.scores[i]) < 1e-9
        assert len(predict.place) <= 50 and max(most) <= 7
