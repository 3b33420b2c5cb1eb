import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LINE = "the quick brown fox jumps over the lazy dog near the old river bank today"


def odd_rows():
    """NULLs in every column, empty and blank texts, ties, repeated rows, one long text."""
    long = " ".join(f"word{i % 997} other{i % 13}" for i in range(30_000))
    return [
        (5, "Hello  world, this is a text.\nAnother line of this text follows here.", "en", "a", 60),
        (5, "Hello  world, this is a text.\nAnother line of this text follows here.", "en", "a", 60),
        (7, None, None, None, None),
        (None, "a row without an id but with some words in it", "en", None, 40),
        (8, "", "de", "b", 0),
        (9, " \t\r\n \x0b", "de", "", 5),
        (1, LINE + "\n" + LINE, "fr", "b", 100),
        (2, LINE.replace("today", "now"), None, "b", 70),
        (3, "été über 日本語 😀 <|endoftext|> $$$ ### |||", "fr", "é", 30),
        (-4, long, "es", "a", len(long)),
        (2**40, "x", "es", "a", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with further columns whose names clash with inputs and internals."""
    spark.conf.set("spark.sql.caseSensitive", "true")
    df = spark.createDataFrame([(*r, "clash", 1.5, 7, "c") for r in odd_rows()], DOCS + ", TEXT string, score double, tie int, c0 string")
    df = spark.createDataFrame(df.rdd, df.schema)
    spark.conf.set("spark.sql.caseSensitive", "false")
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
