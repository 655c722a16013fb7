import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, items string, "
          "fingerprint string, n_words long, h long, id long, key long, `a b.c` string")


def edge_rows():
    """Nulls, empty and very long texts, repeated rows and ids, odd characters."""
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(30_000))
    texts = {None: "a null id", 1: None, 2: "", 3: long, 4: long, 5: "a" * 70_000, 6: "\n\n \t\n", 7: "İ ΣΑΣ ǅ ½ 🙂 \x00   x",
             8: "one", 9: "one", 10: "The quick brown fox. Jumps over\nthe lazy dog! " * 40, 11: "...!!!", 12: "1" * 5000 + "." + "2" * 5000,
             13: "%41%4", 14: "+1 (234) 567-8901 a.b@c.de 10.0.0.1 4111 1111 1111 1111"}
    rows = [(i, t) for i, t in texts.items()]
    rows += [(3, long), (8, "one"), (8, "two"), (2, ""), (None, None), (None, "a null id")]
    return [(i, t, None if i in (1, 8) else "en" if (i or 0) % 2 else "de", "s", len(t or ""), 0.5, "x", "y", 7, 1, 2, 3, "z") for i, t in rows]


@pytest.fixture(scope="session")
def edges(spark):
    """A table of edge cases whose extra columns have the names of operators' own."""
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").cache()
