"""Inputs with every awkward case at once."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that operators compute or use inside, in other cases too.
CLASHING = (
    "size SIZE_ID id row text_crc32 shard slot virtual_slot n_words spans items chars node component key"
    " copies rate target taken score predicted held_out x words lines found owner bytes"
).split()


def sentence(seed: int, n: int = 40) -> str:
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k * seed) % 997}" for k in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with NULLs in every column, empty and long texts, ties, repeated rows, clashing columns."""
    long_text = " ".join(sentence(k, 50) for k in range(700))
    rows = [
        (1, sentence(1), "en", "a", 1),
        (2, sentence(1), "en", "a", 1),
        (2, sentence(1), "en", "a", 1),
        (3, None, "en", "b", 0),
        (4, "", "en", None, 0),
        (5, " \t\n\r ", None, "b", 5),
        (None, sentence(2), "de", "c", 7),
        (None, None, None, None, None),
        (6, long_text, "en", "a", 9),
        (7, "one", "en", "c", 3),
        (7, "two words", "en", "c", 3),
        (8, "ÄÖ é 漢字 😀 end", "de", "b", 9),
        (9, "x\n" * 50, "en", "b", 9),
        (-5, sentence(3, 300) + " tail", "en", "a", 1),
        (10, sentence(3, 300), "en", "a", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr("*", *(f"'c' AS `{name}`" for name in CLASHING))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [
        (1, sentence(1, 12)), (1, sentence(1, 12)), (2, "two words"), (3, None), (4, ""), (None, "漢字 😀"),
        (5, sentence(3, 30)),
    ]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(k, k % 2, 0) for k in range(-5, 11)] + [(None, 1, 0), (3, None, 1), (4, 7, 0)],
        "doc_id bigint, quality bigint, toxic bigint",
    )
