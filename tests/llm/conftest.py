import random

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text), over several partitions."""

    def build(*rows, partitions=3):
        return spark.createDataFrame(list(rows), DOCS).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def prose():
    """Random sentences that repeat nothing by accident."""

    def build(seed, words, letters="abcdefghij"):
        chance = random.Random(seed)
        return " ".join(
            "".join(chance.choice(letters) for _ in range(chance.randrange(3, 9))) for _ in range(words)
        )

    return build


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Null ids and texts, empty and blank texts, ties, repeated rows, and columns with the operators' own names."""
    a, b = prose(1, 120), prose(2, 60)
    rows = [
        (1, a), (2, a), (2, a), (3, a + " "), (4, None), (5, ""), (6, " \t\n"), (None, b), (None, None),
        (7, "one"), (8, "one two"), (9, "One"), (10, b.upper()), (11, "é" * 300), (12, "mail a.b@c.de now"),
    ]
    names = ["key", "own", "text_key", "fp", "row", "sha", "n", "unit", "node", "component", "places", "body", "spans", "p", "x", "id"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([(*r, *names) for r in rows], schema).repartition(3)
