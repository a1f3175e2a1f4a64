import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns whose names operators also use."""
    clash = "fp string, component string, n string, score string, spans string, items string, n_words string, row string, _n string, _id string, size string, copies string"

    def make(rows, extra=False):
        full = [(r[0], r[1], *(r[2:] or ("en", "src0")), len(r[1]) if r[1] is not None else None) for r in rows]
        if not extra:
            return spark.createDataFrame(full, DOC)
        return spark.createDataFrame([(*r, *["x"] * 12) for r in full], f"{DOC}, {clash}")

    return make


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnoprstué") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, a repeated id with another text, and a long text."""
    long = prose(5, 30_000)
    return [(None, None, None, None), (None, "some words here", None, None), (1, None, "en", None), (2, "", None, "b"), (3, " \n\t ", "en", "b"),
            (4, "one two three", "en", "a"), (4, "one two three", "en", "a"), (4, "quite another text", "en", "a"), (5, long, "fr", "a"), (6, long, "fr", "c")]
