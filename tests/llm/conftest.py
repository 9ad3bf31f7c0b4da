import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, row string, block int"


@pytest.fixture(scope="session")
def docs(spark):
    """The documents of the smallest tables with null, empty, long, repeated and tied rows and extra columns."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    extra = [
        (None, "a null id with some words in it", None, None, None), (9001, None, "en", "src1", None), (9002, "", "en", "src1", 0),
        (9003, " \t\n ", None, None, 4), (9004, "one", "en", "src2", 3), (9005, "one two", "en", "src2", 7),
        (9006, "word " * 30000, "en", None, 150000), (9007, "x" * 5000, "en", "src3", 5000),
        (9008, "Straße ÄÖÜ naïve 日本語 😀 <|endoftext|> it's", "de", "src3", 40),
        (9009, "same text here", "en", "src1", 14), (9009, "same text here", "en", "src1", 14), (9010, "same text here", "fr", "src4", 14),
        (9009, "other text under the same id", "en", "src1", 28),
    ]
    return spark.createDataFrame([(*r, 0.5, "x", "y", 7) for r in rows + extra], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
