import random

import pytest

from tests.conftest import rows  # noqa: F401  (this file, too, is named conftest to tests that import it from there)

DOCS = "doc_id long, text string, source string, n_chars long, size long, n long, hits string, key string, h string, rank int, component int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, s, None if t is None else len(t), 1, 2, "x", "y", "z", 3, 4) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, source): near and exact copies, ties, nulls, empty and long texts, repeated rows."""
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Ünder", "éa", "THE", "the", "Of"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    rows, shared = [], "This very line is found in many of the documents here, always the same."
    for i in range(40):
        rows.append((i, text(r.randint(1, 80)) + "\n" + (shared + "\n") * r.randint(0, 2) + text(5), f"s{i % 4}"))
    base = text(120).split()
    for i in range(40, 70):  # near copies with growing edits, crossing the threshold
        w = list(base)
        for _ in range(i - 40):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((i, " ".join(w), "s0"))
    rows += [(i, "one two three", "s1") for i in range(70, 75)]
    rows += [(75, None, None), (76, "", "s2"), (77, " \t\n ", None), (78, None, "s9"), (None, "no id at all", "s1")]
    rows += [(79, text(20_000), "s3"), (80, "x" * 70_000, "s3"), (81, "a  b\x0bc d é", "s1")]
    rows += [(82, "twice the same row and text", "s2")] * 2 + [(83, "same id first", "s2"), (83, "same id second one", "s2")]
    return rows
