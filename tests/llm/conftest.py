import pytest
from pyspark.sql import Row

LONG = "Many words stand here in one very long text. " * 3000


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids and texts, empty and long texts, copies, repeated rows, and columns with names that operators use."""
    rows = [
        (1, "A plain text of some words that stand here, one after the other. Another line.\nAnd a third."),
        (2, None), (3, ""), (4, "   \n\n "), (5, "x"), (6, LONG), (7, LONG), (8, "漢字 😀 ﬁ\t\r\n ▁ end"),
        (9, "A plain text of some words that stand here, one after the other. Another line.\nAnd a third."),
        (10, "repeated row with a few words"), (10, "repeated row with a few words"),
        (None, "a text without an id"), (None, None), (12, "a" * 70_000), (13, "1" * 5000 + " + 5.5"),
        (14, "Contact a.b@c.example.org or +1 (555) 123-4567 now."),
    ]
    schema = ("doc_id long, text string, score double, predicted int, shard int, high long, n_links long, row string, "
              "n_removed long, ids array<int>, id string, held_out boolean")
    return spark.createDataFrame(
        [(i, t, 0.5, 1, 2, 3, 4, "r", 5, [1], "z", True) for i, t in rows], schema)


@pytest.fixture(scope="session")
def no_rows(messy):
    return messy.limit(0)


def plain(df):
    return [tuple(r) for r in df.collect()]


def make(spark, rows):
    return spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows], "doc_id long, text string")
