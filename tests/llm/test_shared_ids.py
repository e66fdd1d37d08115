"""Near-dedup of rows that share an id but not the text."""

from tidegrid.llm import minhash


def text(name, changed=()):
    return " ".join(f"{name}{'x' if i in changed else ''}{i}" for i in range(80))


def test_texts_under_one_id_are_judged_each(spark):
    rows = [(2, text("b")), (5, text("a")), (5, text("b", {70})), (5, text("c")), (7, text("c", {3})), (5, text("c")), (9, text("d")), (9, text("d", {40}))]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int")
    judged = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert judged == {(2, 2, True), (5, 5, True), (5, 2, False), (7, 5, False), (9, 9, True), (9, 9, False)}
    for parts in (1, 7):
        kept = [tuple(r) for r in minhash.keep_one_of_each(docs.repartition(parts)).select("doc_id", "text", "n").collect()]
        assert sorted(t for _, t, _ in kept)[:3] == sorted([text("a"), text("b"), text("c")])
        assert len(kept) == 4 and sum(d == 9 for d, _, _ in kept) == 1
        seen = sorted(kept) if parts == 1 else seen
        assert sorted(kept) == seen
