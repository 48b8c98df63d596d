import pytest

#: Nulls in any column, empty and odd texts, ties and repeated rows; extra columns with clashing names.
LONG = "Lorem ipsum dolor sit amet " * 4000
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35),
    (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35),
    (2, None, "en", None, None),
    (3, "", None, "s1", 0),
    (None, "alpha beta gamma delta epsilon zeta", "en", "s2", 35),
    (None, None, None, None, None),
    (4, " \t\n ", "de", "s2", 4),
    (5, LONG, "en", "s1", len(LONG)),
    (6, LONG, "en", "s1", len(LONG)),
    (7, "naïve café \U0001f600 ü x y", "fr", "s3", 18),
    (7, "another text under the same id", "fr", "s3", 30),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASH = ["fp", "root", "key", "size", "doc", "q", "kept", "node", "shard", "parts", "pos", "taken", "findings", "i"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(c).alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
