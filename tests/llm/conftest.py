import pytest

from salesops.llm import registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    registry.ship(spark)


LONG = "lorem ipsum " * 20_000
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "The same text, twice over, again."), (5, "The same text, twice over, again."),
    (6, "The same text, twice over, again."), (None, "no key here at all"), (None, None), (7, LONG), (8, "x" * 5_000),
    (9, "Zażółć gęślą jaźń 日本語 é İ it's"), (10, "<|endoftext|> a<|startoftext|>b"),
]
CLASHING = "key string, row string, node string, kind string, label string, part string, position string, word string, slot int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and keys, and columns named like inner ones."""
    rows = [(k, t, *["c"] * 8, 3) for k, t in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
