import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

def text(seed: int, n: int = 60) -> str:
    """Invented words, the same for the same seed."""
    return " ".join(f"w{seed}x{k * 7919 % 9973}" for k in range(n))


def odd_texts() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, short texts."""
    long = " ".join(text(k, 400) for k in range(100, 130))
    copy = text(1).split()
    near = " ".join([*copy[:58], "changed", "end"])
    return [
        (1, text(1), "en", "a", 5), (2, text(1), "en", "a", 5), (3, near, "en", "b", 5), (4, text(2), None, None, None),
        (5, None, "en", "a", None), (6, "", "en", "a", 0), (7, " \t\n\x0b ", "en", "a", 5), (8, "one", "en", "a", 3), (9, "One", "en", "c", 3),
        (10, "two words", "en", "a", 9), (11, long, "en", "a", len(long)), (11, long, "en", "a", len(long)), (None, text(3), "en", "a", 3),
        (None, text(3), "en", "b", 3), (None, None, None, None, None), (12, "häße Größe   naïve 日本語 テキスト", "de", "a", 1),
        (13, "ha " * 300, "en", "a", 900), (14, "x" * 5000, "en", "a", 5000), (15, text(1).upper(), "en", "a", 5),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_texts(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = "id key n cls comp root token row at start end value base more score label x c0 c1 found_id spans words lines bin shard length cluster".split()
    return odd.select("*", *[F.lit("extra").alias(n) for n in names])
