import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def texts():
    """Whole texts of the small documents table, by doc_id."""
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty texts, repeated rows, ties, a very long text and columns
    whose names clash with the operators'."""
    long = "lorem ipsum dolor sit amet " * 60_000
    line = "a line that several documents share, word for word"
    rows = [
        (1, None, "n", 0), (2, "", "n", 1), (3, line + "\nown line of three, quite long", None, 2), (4, line, "n", 3),
        (4, line, "n", 3), (5, "  " + line.upper() + "\t\nshort", "n", 4), (None, line, "n", 5), (7, long, "n", 6), (8, " \n\t ", "n", 7),
        (9, "日本語 текст ñandú\u0000 end", "n", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
