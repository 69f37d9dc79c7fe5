import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "abc déf " * 12_000 + "x" * 70_000


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows and ids, and clashing names."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (4, "12 34 !!", "de", "a", 8),
        (5, "the same words in two rows", "en", "b", 26),
        (5, "the same words in two rows", "en", "b", 26),
        (5, "another text with the same id", "en", "b", 29),
        (None, "a row that has no id", "en", None, 20),
        (None, "a row that has no id", "en", None, 20),
        (None, None, None, None, None),
        (7, LONG, "fr", "c", len(LONG)),
        (8, LONG, "fr", "c", len(LONG)),
        (9, "Ünïcødé テキスト 🙂🙂   x́ İI ſK <|endoftext|> it's", None, "c", 40),
        (10, "the same words in two rows", None, "b", 26),
        (-3, "The Same Words in two  ROWS", None, "b", 27),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = "fp u v node root row word n known base score lang_pred component_id fingerprint hash ids decoded spans shard size slot id part kept h slots pos item_id h _text _hash _copies".split()
    return df.withColumns({c: F.lit(c) for c in dict.fromkeys(clash)})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
