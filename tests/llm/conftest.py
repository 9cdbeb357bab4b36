import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", "en", "s", 3),
        (4, "the the the", "en", "s", 11),
        (4, "the the the", "en", "s", 11),
        (5, "word " * 60_000, "en", "s", 300_000),
        (6, "x" * 400_000, "en", None, 400_000),
        (7, "123 456 !!! ???", None, "s", 15),
        (None, "a document without an id but with a few plain words of text in it", "en", "s", 60),
        (8, "a document with an id and with a few plain words of text in it", "en", "s", 60),
    ]
    wide = spark.createDataFrame(rows, DOC)
    from pyspark.sql import functions as F

    clash = ("id", "fp", "key", "mask", "n", "head", "c", "component_id", "kept", "score", "bucket", "weight", "u", "text_", "label", "span", "rank", "_head", "_rows")
    return wide.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
