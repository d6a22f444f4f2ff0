from __future__ import annotations

import random

import pytest


def prose(rng: random.Random, n: int, words=("the", "of", "and", "river", "stone", "Green", "walk", "three", "é", "über", "x1", "night,", "day.")) -> str:
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "a", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows of (doc_id, text): copies, near copies, shared passages, odd and long texts, repeated rows, nulls."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    passage = prose(rng, 60)
    texts = base + base[:6] + [passage] + [prose(rng, 10) + " " + passage + "\n" + prose(rng, 10) for _ in range(8)]
    for b in base[:15]:
        words = b.split(" ")
        for _ in range(3):
            w = list(words)
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += ["", " ", " \t\n", "word", "Word", "a b", "....", "0", "a" * 300, "ab" * 200, "é" * 120, prose(rng, 8000), "x" * 60 + "é" * 40]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(k, texts[i]) for k, i in enumerate(order)]
    rows += [(rows[3][0], rows[3][1]), (None, base[0]), (None, None), (500, None), (501, base[1])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as a table with further columns that have awkward names."""
    rows = [(i, t, "en", f"s{k % 3}", len(t or ""), k, "x", None) for k, (i, t) in enumerate(corpus)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, n_words int, shard string, node string")
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
