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
        # Names that operators use for columns of their own.
        T.StructField("key", T.StringType()),
        T.StructField("sid", T.LongType()),
        T.StructField("tie", T.StringType()),
        T.StructField("__key0", T.StringType()),
        T.StructField("n_words", T.StringType()),
    ]
)


def rows_of(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [
        (doc, text, "en", "s", None if text is None else len(text), "k", 1, None, "x", None)
        for doc, text in zip(ids, texts, strict=True)
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a table of documents with further columns."""

    def make(texts, ids=None, parts=3):
        return spark.createDataFrame(rows_of(texts, ids), SCHEMA).repartition(parts)

    return make


WORDS = [a + b for a in "tha ere ing ion pa qu lo mi".split() for b in "st nd o en ar u".split()]


def prose(seed, words, line=9):
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append(rng.choice(WORDS))
        out.append(".\n" if i % line == line - 1 else " ")
    return "".join(out).strip()


@pytest.fixture(scope="session")
def edge_texts():
    """Null, empty, blank, tiny, repeated and very long texts, and odd characters."""
    return [
        None,
        "",
        " \n\t ",
        "word",
        "word",
        "a b c d",
        "é́ \U0001f600 ​\x00 end",
        prose(1, 60),
        prose(1, 60),
        prose(2, 6000),
        "x" * 70000,
        "the the the " * 50,
        " " * 40000 + "y",
    ]
