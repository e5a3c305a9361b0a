"""Documents with everything that an operator must bear."""

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, score double"


def prose(draw: random.Random, n: int) -> str:
    return " ".join(draw.choice(WORDS) + str(draw.randrange(30)) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars and columns whose names operators use themselves): copies, near copies, nulls, blanks, a very long text, ties, a repeated row."""
    draw = random.Random(5)
    texts = [prose(draw, draw.randrange(5, 200)) for _ in range(60)]
    near = texts[0].split()
    near[len(near) // 2] = "changed"
    texts += [texts[1], texts[1], texts[1].upper(), " ".join(near), "", " \t\n", None, "one", "two words", prose(draw, 30_000), "Ünïcödé ß 中文 🎉 é " * 20, "\x0b\x0ca\x1cb c"]
    out = [(i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"src{'ab'[i % 5 == 0]}", None if t is None else len(t), 7, "k", 0.5) for i, t in enumerate(texts)]
    return [*out, out[3], (None, "a row without id", "en", "src0", 16, 7, "k", 0.5)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def named(spark, rows):
    """Without the row that has no id and the repeated one."""
    return spark.createDataFrame(rows[:-2], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
