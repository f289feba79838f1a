from __future__ import annotations

import random

import pytest

CLASHING = ["row", "key", "doc", "id", "kept", "host", "print", "n_words", "window", "other", "root", "size"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: NULLs, empty and very long texts, ties, repeated rows, copies."""
    rng = random.Random(5)
    long = " ".join(sentence(rng, 50) + rng.choice(".\n") for _ in range(800))
    a, b = sentence(rng, 120), sentence(rng, 60)
    w = a.split()
    near = " ".join([*w[:60], "changed", *w[61:]])
    far = " ".join([*w[:20], "x1", *w[21:40], "x2", *w[41:60], "x3", *w[61:80], "x4", *w[81:100], "x5", *w[101:]])
    return [
        (None, a), (None, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, long), (5, a), (5, a), (6, a), (7, near), (8, far),
        (9, b), (10, b + "\n" + b), (11, "one two three"), (12, "one two three"), (13, "One  two\nTHREE"), (-14, b), (15, "naïve\x1cÜBER\u00a0x \u2581 é"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    rows = [(i, t, "en", [None, "s1", "s2"][k % 3], None if t is None else len(t), *["x"] * len(CLASHING)) for k, (i, t) in enumerate(edge_texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
