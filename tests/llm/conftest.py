import random

import pytest

SCHEMA = "doc_id long, text string, size int, doc string, n string, sid long, shard string"


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names the operators use inside."""
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta", "eps", "zeta", "eta", "theta", "ÄÖ", "日本", "x1"]
    texts = [None, "", " \t\n", "one two", "one  two ", "onetwo", "ONE two", "a b c d e f g h", "a b c d e f g H"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) + rng.choice(["", "\nshared line of text\n", "\n Shared LINE of text"]) for _ in range(40)]
    texts += ["shared line of text\nshared line of text\nown line number one", "w" * 20000, "word " * 5000]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(7, "a b c d e f g h"), (7, "a b c d e f g h"), (None, "one two"), (None, None), (3, "one two")]
    base = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(60)]
    for i in range(30):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randint(0, 999)}"
        rows.append((1000 + i, " ".join(copy)))
    return [(i, t, 1, "d", "n", 5, "s") for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
