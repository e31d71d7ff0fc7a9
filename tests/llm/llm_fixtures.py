"""Fixtures of the operator tests."""

import pytest

SF_DIR = "/root/testdata/sf0.001"

#: Clashing names, in any case, of everything the operators add.
EXTRA = (
    "n_words kept n_tokens copies slot Shard text_hash component_id __text __words __keys __plan __copies __mix_id "
    "spans gone_id leak_id twice_id cid root count"
).split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids."""
    prose = "The river rose by two metres on monday and the lower road was closed until the evening of the day. " * 3
    words = " ".join(f"w{i}" for i in range(120))
    return [
        (1, prose, "en", "src0", 5),
        (2, prose, "en", "src0", 5),
        (2, prose, "en", "src0", 5),
        (3, None, None, None, None),
        (4, "", "en", "src1", 0),
        (5, " \t\n ", "xx", "src2", 1),
        (6, words, "de", "src0", 1),
        (6, words + " tail", "de", "src0", 1),
        (7, words.upper(), None, "src3", 1),
        (None, words, "fr", None, 1),
        (None, None, None, None, None),
        (8, "one two", "es", "src1", 1),
        (9, "One two", "es", "src1", 1),
        (10, " ".join(f"x{i % 977}" for i in range(60000)), "en", "src12", 1),
        (11, "ä ö ü 日本 \x0b\x0c end\r\n\r\nend", "de", "src0", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(k).alias(name) for k, name in enumerate(EXTRA)])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
