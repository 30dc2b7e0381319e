import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, stem):
    return " ".join(f"{stem}{rng.randrange(400)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = words(rng, 30_000, "w")
    base = [words(rng, 80, "d") for _ in range(6)]
    near = base[0].split()
    near[40] = "changed"
    rows = [
        (0, base[0], "en", "a", 1),
        (1, base[0], "en", "a", 1),
        (1, base[0], "en", "a", 1),
        (2, " ".join(near), "en", None, None),
        (3, None, None, None, None),
        (4, "", "de", "b", 0),
        (5, " \t\n", "de", "b", 0),
        (6, "One Two", "fr", "b", 7),
        (7, "ONE two", "fr", "c", 7),
        (8, long, "en", "a", 1),
        (9, long + " end", None, "a", 1),
        (None, base[1], "en", "a", 1),
        (None, base[1], "en", "a", 1),
        (10, "!!! 123 ...", "es", "c", 3),
        (11, "né Été İ. <|endoftext|> é", "fr", "c", 3),
    ]
    return rows + [(20 + i, base[2 + i % 4] + f" tail{i // 4}", "en", "d", 1) for i in range(40)]


@pytest.fixture
def odd(spark, odd_rows):
    """With extra columns whose names the operators like to use themselves."""
    docs = spark.createDataFrame(odd_rows, COLUMNS)
    return docs.selectExpr("*", "doc_id as score", "text as key", "source as rank", "1 as n_words", "2 as block", "3 as shard", "4 as _n_hit")


@pytest.fixture
def nothing(odd):
    return odd.where("false")
