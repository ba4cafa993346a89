import pytest

CLASHES = ["score", "row", "lines", "line", "key", "doc", "hash", "n", "bands", "bucket", "name", "rest", "class_id", "held_out", "lang", "ids", "order", "mix_block", "c0", "label", "place", "size"]


@pytest.fixture(scope="session")
def docs(spark):
    """rows -> DataFrame of (doc_id, text) and columns whose names an operator might use itself."""

    def make(rows):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return df.selectExpr("*", *(f"cast(null as string) as `{c}`" for c in CLASHES), "concat('s', doc_id % 3) as source", "length(text) as n_chars").repartition(3)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null ids and texts, empty and blank texts, repeated rows, ties, one very long text and one very long word."""
    return [
        (None, "one two three four five six"), (1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six"), (4, "one two three four five six"),
        (5, "one two three four five six"), (-7, "é" * 5000 + " ü　x"), (6, "word " * 30_000), (7, "a" * 60_000), (8, "one"), (9, "\n\none\n\none two\n"), (2**62, "tail"), (8, "another text of id eight"),
    ]
