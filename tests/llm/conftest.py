import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHING = ("id size row end index digest key tie start block bucket fp node root hash words items "
            "place g c doc tag label slot shard taken held_out score _key url_").split()


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in any column, empty and long texts, ties and repeated rows."""
    long_text = "eins zwei drei vier " * 20_000 + "ende"
    passage = "a passage of more than fifty bytes that several documents share word for word"
    rows = [
        (1, "The quick brown fox jumps over the lazy dog today", "en", "b", 1),
        (1, "The quick brown fox jumps over the lazy dog today", "en", "b", 1),
        (2, "the quick brown fox jumps over the lazy dog today", "en", None, None),
        (3, None, "en", "a", None), (4, "", None, "a", 0), (5, "   \n\t", "de", "", 0),
        (6, long_text, "de", "b", 1), (7, long_text + " neu", "de", "b", 1),
        (None, "ohne kennung aber mit text und mit genug wörtern für eine prüfung", "de", "a", 1),
        (8, f"one {passage} two", "en", "c", 1), (9, f"three {passage} four", "en", "c", 1),
        (10, "x", "en", "c", 1), (11, "12345 67890 !!!", "en", "c", 1),
        (12, "tab\tand\x0bvertical\x0c<|endoftext|> special é ß 漢字   line", "en", "c", 1),
        (5, f"{passage}", None, "d", 1), (2**40, "großes ende", "de", "é", 1),
        (10, "x", "en", "c", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing():
    def add(df):
        from pyspark.sql import functions as F
        return df.select("*", *(F.lit(7).alias(c) for c in CLASHING if c not in df.columns))
    return add


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
