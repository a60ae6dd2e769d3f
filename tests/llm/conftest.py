from __future__ import annotations

import random

import pytest

#: Texts that every operator on documents must take: null, empty, blank, repeated, tied, and very long ones.
ODD = [None, "", " \t\n", "a", "A b", "é" * 40, "no letters? 123 !!", "x" * 60]


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(300)]


@pytest.fixture(scope="session")
def fixture_rows(words):
    """Documents with copies, near copies, shared passages, odd texts, a very long text and repeated rows."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [text(rng.randint(1, 120)) for _ in range(40)]
    base, passage = text(100), text(30)
    texts += [
        base,
        base,
        base.upper(),
        *[" ".join(rng.choice(words) if rng.random() < p else w for w in base.split()) for p in (0.01, 0.02, 0.03, 0.05, 0.1)],
    ]
    texts += [f"{text(10)} {passage} {text(10)}" for _ in range(6)] + [
        passage, passage[:50], passage[:49], text(4), *ODD, "ö".join(texts[:3]), " ".join(texts[:20]) * 3
    ]
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["b", "a", None, "é"][i % 4]) for i, t in enumerate(texts)]
    return [*rows, rows[0], (rows[5][0], "another text under a known id", "en", "a")]


@pytest.fixture()
def fixture_docs(spark, fixture_rows):
    """The rows, and columns whose names operators use inside."""
    df = spark.createDataFrame(fixture_rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr(
        "*",
        "length(text) as n_chars",
        "'x' as score",
        "1 as _b",
        "2 as node",
        "3 as comp",
        "4 as size",
        "5 as taken",
        "'k' as ids",
        "6 as n",
    )


@pytest.fixture()
def no_docs(fixture_docs):
    return fixture_docs.limit(0)
