import random

import pytest

WORDS = "alpha beta gamma delta river stone cloud ember falcon garden harbor island jungle kettle lemon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Text string, size string, kept int"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "ed", "s"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, ties, repeated rows, other scripts and control strings."""
    rng = random.Random(7)
    base = sentence(rng, 300)
    near = base.split()
    near[150] = "changed"
    return [
        None, "", " ", "\n\n", "one", "One  two\tthree four", base, base, " ".join(near), base.upper(), sentence(rng, 40), sentence(rng, 40),
        "naïve Größe 日本語 ﬁne 😀 ▁x́", "<|im_start|>user\n\\<|im_end|>", "a" * 500, ("word " * 60).strip(), sentence(rng, 20_000), "12345 !!! 678",
        "x\r\ny\x0bz\x00", "\n".join([sentence(rng, 12)] * 4),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts as documents with clashing extra columns, a repeated row and a row without id."""
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "é"][i % 4], 0, "other", "z", 1) for i, t in enumerate(odd_texts)]
    rows += [rows[6], (None, odd_texts[6], "en", "a", 0, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
