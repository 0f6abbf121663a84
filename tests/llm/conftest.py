import random

import pytest

WORDS = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("r", "st", "l", "nd", "x")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        """rows: (doc_id, text[, lang, source]); extra: names of more columns."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or ""), *["x"] * len(extra)) for r in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", `{e}` string" for e in extra))

    return make


CLASHING = ("copy", "size", "weight", "shard", "predicted", "share", "component", "rep", "bands", "__gone", "__r", "__source", "__at", "__slot", "digest", "key", "label")


@pytest.fixture
def odd_rows(rng):
    """Nulls, empties, repeats, a long text, ties."""
    long = prose(rng, 60_000)
    base = prose(rng, 80)
    return [(1, None), (2, ""), (3, "   \n\t "), (4, base), (4, base), (5, base), (None, base), (None, None), (6, long), (7, "a"), (8, "!!! ???"), (9, prose(rng, 50), None, None), (10, prose(rng, 40), "", "src1")]
