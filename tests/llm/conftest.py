import pytest

from augury.session import importable

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="session")
def _workers_find_the_package(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 7000}" for i in range(40_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta"),
        (2, "alpha BETA gamma delta epsilon zeta"),
        (2, "alpha BETA gamma delta epsilon zeta"),
        (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "one two"), (8, "É é 漢字 😀 \x1c x"),
        (9, long), (10, long + " end"), (None, "alpha beta gamma delta epsilon zeta"), (None, None),
        (11, "unique words of a text that nobody else has at all here"), (12, "x" * 3000),
    ]
    clash = "hash long, node long, uid string, n int, token string, archive int, host string, length int"
    data = [(*r, 1, 2, "u", 3, "t", 4, "h", 5) for r in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, source string, {clash}".replace("source string, ", "")).withColumn(
        "source", _host()
    )


def _host():
    from pyspark.sql import functions as F

    return F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise("host")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
