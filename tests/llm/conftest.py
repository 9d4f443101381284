import random

import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, block long, kind string, rank_ int, lines string, removed string, component long, node string, gid long, signs string, span string, tie string, words string, key string, a string, b string, n string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon the of and to is der die und".split()


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names clash with those inside the operators."""

    def of(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "x", 1, "x", "x", 1, "x", 1, "x", "x", "x", "x", "x", "x", "x", "x") for i, t in rows], SHAPE).repartition(3)

    return of


@pytest.fixture(scope="session")
def corpus():
    """Small documents with copies, near copies, shared passages, repeats, and odd texts."""
    rng = random.Random(7)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = [prose(rng.randrange(1, 50))]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(2), rng.choice(shared))
        if rng.random() < 0.2:
            parts += [parts[0]]
        texts.append("\n".join(parts))
    for t in list(texts[:12]):
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts += [t, " ".join(w)]
    texts += ["", None, None, " \t\n", "one", "two words", "a a a a " * 40, "x " * 80, "é" * 120, "é" * 120 + "ü" * 60, "日本語" * 40, "token = 'abcdef0123456789' " * 3, texts[0].upper(), texts[1].replace(" ", "  "), "line\n" * 50, "\x02 odd \x1c <|endoftext|> 12"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    # rows that repeat, an id that repeats with another text, rows without id
    return [*rows, rows[0], (rows[1][0], "another text of the same id"), (None, texts[0]), (None, None)]
