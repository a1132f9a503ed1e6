import pytest

#: Odd rows that every operator on documents must take: nulls, empty and long texts, ties, repeated rows.
ODD = [
    (1, "The cat sat on the mat.\nThe cat sat on the mat.", "en"),
    (2, "the CAT sat on the mat.\nThe cat sat on the mat.", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, "   \n\t ", "en"),
    (6, "élan vital, naïve façade; Ünïcode ★ 🙂 12345 x'll  two  spaces \n \n end ", "fr"),
    (7, "word " * 5000, "en"),
    (8, "x" * 20000, None),
    (9, "<|endoftext|> #*$%&|<> odd", "en"),
    (9, "<|endoftext|> #*$%&|<> odd", "en"),
    (None, "no id", "en"),
    (11, "a b c", "en"),
    (12, "A B C", "en"),
    (13, "a b c d", "en"),
]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string")


@pytest.fixture()
def clashing(odd):
    """The odd rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    out = odd
    for name in ("ids", "score", "length", "sequence_id", "offset", "kept", "key", "shard", "slot", "_hash", "_bin", "piece", "start", "fingerprint", "component_id", "size", "token", "count"):
        out = out.withColumn(name, F.lit("clash"))
    return out


@pytest.fixture()
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
