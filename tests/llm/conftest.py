import random

import pytest

LONG = "".join(random.Random(2).choice("abcdefgh") for _ in range(60_000))
WORDS = [f"w{k:03d}" for k in range(400)]


def passage(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefghij") for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a null id, columns that clash with names used inside."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d"), (6, LONG), (7, passage(1, 6000)), (8, passage(2, 60)),
            (8, passage(2, 60)), (9, passage(2, 60)), (None, "no id here"), (10, "É è 日本語\x00 🙂  x"), (11, "#### *** $$$ %%%")]
    clash = ("x", 0, [1], "y", 0.5, True)
    return spark.createDataFrame(
        [(i, t, *clash) for i, t in rows],
        "doc_id long, text string, id string, h int, bands array<int>, base string, score double, kept boolean")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def make_passage():
    return passage


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"
