import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, ids from 1, with columns whose names clash with results."""

    def make(texts, sources=None, ids=None):
        rows = [(ids[k] if ids else k + 1, t, "en", sources[k] if sources else "s", 0, "x", 1.0, "y") for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS + ", size string, score double, component_id string")

    return make


@pytest.fixture
def words():
    rng = random.Random(5)
    pool = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(60)]
    return lambda n: " ".join(rng.choices(pool, k=n))


#: Null, empty, blank, one word, repeats, other scripts, a long text.
EDGE_TEXTS = [None, "", "   \t\n", "One", "same words here now", "same words here now", "Ärger über 漢字 🙂 \u0000 mixed", "word " * 20_000]
