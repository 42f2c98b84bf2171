import random

import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, key STRING, score STRING, size INT"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) or texts as a documents table with extra columns of clashing names."""
    def make(rows, langs=("en",), sources=("s",)):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, langs[n % len(langs)], sources[n % len(sources)], None, "k", None, 7)
             for n, (i, t) in enumerate(rows)], DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def prose():
    """Texts with copies, near copies, shared passages, ties, nulls, empty, short and one long text."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "Straße", "naïve", "of"]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = fresh(45)
    texts = [None, "", "  \t\n ", "one", "One", "a b c", "A  B\tc", " ".join(fresh(19)), " ".join(fresh(20))]
    for _ in range(12):
        base = fresh(rng.randint(15, 120))
        texts += [" ".join(base), "\n".join(base)]
        near = list(base)
        near[rng.randrange(len(near))] = "edited"
        texts.append(" ".join(near).upper() if rng.random() < 0.3 else " ".join(near))
        texts.append(" ".join(fresh(10) + passage[rng.randint(0, 9):rng.randint(25, 45)] + fresh(12)))
    texts.append(" ".join(fresh(5) * 30))
    texts.append(" ".join(fresh(6000)))
    rng.shuffle(texts)
    return texts
