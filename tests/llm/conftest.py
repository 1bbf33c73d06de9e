import pytest

LONG = "word " * 30_000 + "end"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with names that operators use inside."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and then runs far away from it all", "en", "src1"),
        (1, "the quick brown fox jumps over the lazy dog and then runs far away from it all", "en", "src1"),
        (2, None, "en", "src1"),
        (3, "", None, None),
        (4, "   \n\t ", "fr", "x"),
        (None, "a text without an id but with enough words to be looked at by the rules", "de", "src2"),
        (5, LONG, "en", "src9"),
        (6, "ünïcödé wörds — naïve café 日本語 text\nline two\nline two\n", "fr", "src1"),
        (7, "one", "en", "src1"),
        (7, "another text that shares the id seven with the row before it and is longer", "en", "src3"),
    ]
    df = spark.createDataFrame([(*r, len(r[1] or ""), k, k, k, "x", k) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, block long, key long, row long, bucket string, node long")
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
