"""Documents at the edges, for all operators."""

import pytest
from pyspark.sql import functions as F

WORDS = "the of and ein der que les por idiot cc by nc all rights reserved general public license alpha beta".split()
# Texts at the edges: nothing, white space of several kinds, no words, one word, repeats, very long.
EDGES = [None, "", " \t\n\x0b\x0c\r ", "...!?", "word", "Ünï çödé Wörd\u00a0x", "a\nA \n a\t\n", "same line here\n" * 4,
         "\n\n", "x" * 5000, " ".join(f"w{k}" for k in range(30_000)), "CC-BY cc by. General Public License\nall rights  reserved",
         "### %%% one two three four" * 20, "# a|b <c> & $d * %"]


@pytest.fixture(scope="session")
def corpus(spark):
    """(doc_id, text) rows: edge texts, plain ones with repeats, exact and near copies."""
    import random

    rng, texts = random.Random(5), list(EDGES)
    shared = "this very passage of words stands in a number of documents of the corpus"
    for k in range(90):
        lines = [" ".join(rng.choices(WORDS, k=rng.randint(1, 14))) for _ in range(rng.randint(1, 12))]
        if k % 4 == 0:
            lines.insert(0, shared)
        texts.append("\n".join(lines))
    texts += texts[20:40] + [t + " tail" for t in texts[40:60]]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as documents, with columns whose names operators use for themselves."""
    rows = [(i, text, "en", None if i % 7 == 0 else f"s{i % 4}", 0, "x", "y", 1) for i, text in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "hash string, score string, size int").repartition(3, F.col("doc_id"))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Repeated rows, rows without ids, nulls in all columns."""
    long = " ".join(f"alpha{k} beta" for k in range(60))
    return spark.createDataFrame(
        [(1, "one line of text here\nother", "s"), (1, "one line of text here\nother", "s"), (None, long, None),
         (None, None, None), (2, long, None), (3, None, "s"), (4, long, "t"), (4, long, "t")],
        "doc_id long, text string, source string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
