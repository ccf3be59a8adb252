import pytest

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, part int, copy string, id long, tag string"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


def odd_texts():
    """Texts with nulls, ties, repeats, very long ones and odd characters."""
    words = [f"w{i % 37}x{i % 11}" for i in range(6000)]
    return [
        None, "", " \t\n", "one", "one two three", "One Two Three", "a b c d e", "A\nb  c\td e", "Ünïcode ÄÖ straße 日本語 😀 x",
        " ".join(words), " ".join(words) + " tail", " ".join(reversed(words)), "1234 5678 !!", "password=abcdefgh12", None, "a b c d e",
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts under columns that clash with names inside the operators; a repeated row and a null id too."""
    rows = [(i * 7 - 20, t, ["en", "de", None][i % 3], ["a", None, "b"][i % 3], 5, i, "c", 1, "t") for i, t in enumerate(odd_texts())]
    rows += [rows[9], (None, "one two three", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EXTRA)
