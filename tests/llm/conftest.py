import random

import pytest

WORDS = "the and of is in on to river stone cloud märz façade 1234 x y z alpha beta gamma delta epsilon".split()


def make_text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(200)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, equal texts, and extra columns with clashing names."""
    rng = random.Random(5)
    long = make_text(rng, 6000)
    base = make_text(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "s0"), (2, base, "en", "s0"), (3, " ".join(near), "en", "s1"), (4, None, "en", "s1"), (5, "", None, None), (6, " \t\n ", "de", "s0"),
        (7, long, "en", "s0"), (7, long, "en", "s0"), (8, "One two", "de", "s2"), (9, "one TWO", "de", "s2"), (None, base, "en", "s0"), (None, None, None, None),
        (10, "a\x00b c!d   e", "fr", "s9"), (11, "### $$$ | < > %%% " * 30, "fr", "s9"), (12, "same line here\n" * 40, "fr", "s9"), (13, base + " tail words follow here", "en", None)]
    return spark.createDataFrame([(*r, 3, "clash", 0.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars int, size string, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
