import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for results of their own
        T.StructField("n_words", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("clean", T.StringType()),
    ]
)


def make(spark, texts, schema=SCHEMA):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns."""
    rows = []
    for x in texts:
        doc_id, text, source = (*x, f"s{len(rows) % 3}")[:3]
        rows.append((doc_id, text, "en", source, None if text is None else len(text), "w", "k", "r", "c"))
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def docs_of(spark):
    return lambda texts: make(spark, texts)


@pytest.fixture(scope="session")
def prose():
    """Texts of random words; equal seeds give equal texts."""
    vocabulary = "the of and to in river stone light Über niño garden window thought never always under mit éclair".split()

    def write(seed, n_words, line=12):
        rng = random.Random(seed)
        words = [rng.choice(vocabulary) + rng.choice(["", "s", "ed", "ing", str(rng.randrange(99))]) for _ in range(n_words)]
        return "\n".join(" ".join(words[i : i + line]) for i in range(0, n_words, line))

    return write


@pytest.fixture(scope="session")
def awkward(prose):
    """Keys and texts with every awkward case: nulls, blanks, repeats, ties, a very long text."""
    base = prose(1, 120)
    return [
        (1, base),
        (2, base),
        (2, base),
        (None, base),
        (None, None),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b "),
        (6, "one"),
        (7, "one two"),
        (8, base + " more"),
        (9, prose(2, 60_000)),
        (10, "x " * 40_000),
        (11, prose(3, 200) + "\n" + base),
        (11, prose(4, 90)),
        (12, "ÄÖÜ 漢字 emoji 😀 \x00\x7f end"),
    ]
