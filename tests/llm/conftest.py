import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def table(spark):
    """A documents table from (doc_id, text[, lang]) rows, with columns named like the operators' own."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        return spark.createDataFrame(full, DOCS).selectExpr(
            "*", "1 AS block", "'x' AS key", "2 AS n", "3L AS size", "0 AS piece").repartition(partitions)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented words; the same seed gives the same text."""
    import random

    def make(seed, words):
        rnd = random.Random(str(seed))
        return " ".join("".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rnd.randint(1, 4)))
                        for _ in range(words))

    return make
