import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with results."""
    base = " ".join(f"w{i % 97}x{i % 89}" for i in range(300))
    near = base.replace("w5x5", "changed", 1)
    rows = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n"), (7, "One"), (8, "one two"), (9, "ONE two"),
        (10, "a " * 40_000), (11, "é漢🙂 " * 30 + base), (12, "x" * 50_000), (2, base), (None, base), (13, "1234 5678 !!"),
        (14, "der die das und nicht"), (15, "tail of " + base[:700]),
    ]
    data = [(i, t, "src", 1, True, "hash", 0.5, "text") for i, t in rows]
    schema = "doc_id long, text string, source string, n_chars int, kept boolean, text_sha256 string, score double, keep_id string"
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark, awkward):
    return spark.createDataFrame([], awkward.schema)
