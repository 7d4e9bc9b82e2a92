import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("print", "lines", "gone_id", "gone_lines", "kept_id", "sig", "hilbert", "shard", "slot",
            "word", "bit", "key", "bucket", "chunk", "ids", "kept", "hash_a", "host", "first")


def prose(seed, words=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "river", "stone", "élan", "über", "house", "walked", "under",
                  "seven", "bridges", "while", "nobody", "looked", "cold", "morning", "light"]
    return " ".join(rng.choice(vocabulary) for _ in range(words))


@pytest.fixture
def docs(spark):
    """Build documents from (doc_id, text) pairs."""

    def build(rows):
        full = [(i, t, "en", f"s{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def nasty(spark):
    """Nulls, empty, long and repeated texts and ids, and columns that operators use themselves."""
    long_text = prose(1, 40_000)
    rows = [
        (1, prose(2), "en", "a", 5), (2, prose(2), None, None, None), (3, prose(2) + " again", "en", "a", 1),
        (4, None, "en", "b", None), (5, "", "de", "b", 0), (None, None, None, None, None),
        (None, prose(3), "fr", "c", -1), (None, prose(3), "fr", "c", -1), (6, "\n\n \t\n", "en", "a", 3),
        (7, long_text, "en", "a", 7), (8, long_text, "en", "a", 7), (9, "x" * 100_000, "xx", "", 2),
        (10, "one", "en", "a", 3), (10, "one", "en", "a", 3), (10, prose(4), "en", "a", 3),
        (-11, "日本語 \x00 ▁ 😀", "ja", "a", 9), (2**62, prose(5), "en", "z" * 50, 2**40),
    ]
    extra = [f"c{i}" for i in range(len(CLASHING))]
    df = spark.createDataFrame([(*r, *extra) for r in rows], ", ".join([SCHEMA, *(f"{c} string" for c in CLASHING)]))
    return df.repartition(3)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
