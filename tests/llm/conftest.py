import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns named like an operator's own."""
    long = " ".join(f"word{i % 977} andmore" for i in range(30_000))
    rows = [
        (1, "a b c d e f g h i j k l", "s1"), (2, "a b c d e f g h i j k l", "s1"), (2, "a b c d e f g h i j k l", "s1"),
        (3, None, "s1"), (4, "", None), (None, "no id at all", "s2"), (5, long, "s2"), (6, long + " end", "s3"),
        (7, " \t\n ", "s2"), (8, "Ünïcode\x00 text 😀 🎉\r\n\x0bend", "s4"), (9, "a", "s4"), (10, "A", "s4"), (11, None, None),
    ]
    names = ["size", "shard", "id", "region", "label", "pos", "bucket", "ids", "cost", "decoded", "tie", "place", "target"]
    return spark.createDataFrame(
        [(*row, *range(len(names))) for row in rows],
        "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
