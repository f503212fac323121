import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use for columns of their own.
CLASHES = ["doc", "key", "size", "shard", "slot", "copy", "shuffle_key", "part", "n", "item", "shingle", "class", "chunk", "kept", "verdict",
           "text_group", "own_id", "leak_id", "gone", "twice", "rate", "cdf", "_text"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    long = " ".join(words(rng, 30_000))
    base = words(rng, 80)
    near = base[:40] + ["zzz"] + base[41:]
    return [
        (1, " ".join(base), "en", "a", 1), (2, " ".join(base), "en", "a", 1), (2, " ".join(base), "en", "a", 1), (3, " ".join(near), "de", None, 1),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \t\n ", "en", "b", 4), (7, "One", "en", "b", 3), (8, "one", "en", "b", 3),
        (None, " ".join(base), "en", "a", 1), (None, None, None, None, None), (9, long, "fr", "c", 1), (9, "another text here", "fr", "c", 1),
        (10, "ünï côde\u0000 \U0001f600 x" * 3, "xx", "", 1), (11, "!!! ??? ...", "en", "a", 11),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(1).alias(c) for c in CLASHES])
