"""Small tables with the awkward rows that every operator must take."""

import random

import pytest
from pyspark.sql import types as T

EXTRA = ["id", "row", "node", "size", "key", "copies", "part", "tile", "h", "t", "n", "word", "block", "names", "lang_pred", "score", "kept", "s"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in EXTRA])


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def awkward_rows():
    """(doc_id, text, lang, source): nulls, empty and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = [(k, prose(rng, rng.randint(1, 160), words), "en", f"s{k % 4}") for k in range(10, 60)]
    passage = prose(rng, 70, words)
    for k in range(60, 75):  # a passage in many documents
        a, b = prose(rng, 30, words), prose(rng, 30, words)
        rows.append((k, f"{a} {passage} {b}", "en", "s0"))
    base = prose(rng, 200, words)
    rows += [(k, base, "en", "s1") for k in range(80, 90)]  # copies
    for k in range(90, 110):  # near copies
        w = base.split(" ")
        w[rng.randrange(200)] = "edited"
        rows.append((k, " ".join(w), "en", "s1"))
    huge = prose(rng, 20_000, words)
    rows += [(120, None, "en", "s2"), (121, "", None, "s2"), (122, "   \t\n", "en", None), (123, "12 34 !!", "en", None), (124, huge, "en", "s2"), (125, "x" * 3000, "en", "s3"),
             (126, "the " * 300, "en", "s3"), (127, "one two", "en", "s3"), (128, "one two", "en", "s3"), (129, "One  TWO", "en", "s3"),
             (130, "Größe naïve 日本語 🙂 a b\x1cc", "de", "s3"), (131, base.upper(), "en", "s1"), (None, base, "en", "s1"), (None, "nameless words", None, None),
             (132, prose(rng, 60, words), "en", "s0")]
    rows.append(rows[-1])  # a repeated row
    return rows


def frame(spark, rows):
    full = [(i, t, lang, source, len(t or ""), *[f"x{i}"] * len(EXTRA)) for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
