import random

import pytest

#: Columns whose names operators use themselves.
CLASHING = "size target node n low words row slot draw sign begins part marks root entry letters bands key doc shared".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text, lang, source) as documents with extra columns of clashing names."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
        filled = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), *["x"] * len(CLASHING)) for r in rows]
        return spark.createDataFrame(filled, schema)

    return make


@pytest.fixture(scope="session")
def prose():
    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ba", "ko", "ti", "re", "mu", "lo", "sa", "ne"]) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make
