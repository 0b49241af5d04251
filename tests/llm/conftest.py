import pytest

ODD = [
    (1, "", "en", "a"), (2, None, "en", "a"), (3, "one", None, None), (4, "word " * 3000, "en", "a"),
    (5, "same text here and there", "en", "a"), (5, "same text here and there", "en", "a"),
    (6, "same text here and there", "en", "a"), (None, "text without an id", "en", "a"), (None, None, None, None),
    (7, "\n\n \t\n", "en", "a"), (8, "x" * 50000, "en", "a"), (9, "é😀▁\x01\x00 end", "en", "a"),
]
#: Names that operators use for columns of their own.
CLASH = ["fp", "h", "row", "depth", "bytes", "n", "window", "part", "tail", "copies", "simhash_text", "ids", "spans",
    "words", "kept", "all_spans", "base_spans", "secret_spans", "simhash_copies", "rejected_by"]


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names that may clash."""
    df = spark.createDataFrame([(*r, *CLASH) for r in ODD],
        "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASH))
    return df


@pytest.fixture
def none(odd):
    return odd.limit(0)
