from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def shipped(spark):
    from assaycast.llm.shipping import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def prose():
    """Pseudo-random sentences from a small vocabulary."""

    def make(seed: int, n: int, vocabulary: int = 400) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(2 + k % 6)) for k in (rng.randrange(vocabulary) for _ in range(n)))

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, very long word, many repeats, non-ASCII."""
    return [None, "", " \n\t ", "word", "x" * 200_000, "a b " * 3000, "é è 漢字 🙂 ▁", "line\nline\n\nline two\n", "nul\x00 \x0b end"]


@pytest.fixture(scope="session")
def clash():
    """Extra columns whose names an operator could use itself."""

    def add(df):
        from pyspark.sql import functions as F

        for name in ["id", "node", "key", "row", "doc", "tag", "packed", "h", "size", "kind", "chunk", "bits", "label", "_id", "copy", "words", "hash"]:
            if name not in df.columns:
                df = df.withColumn(name, F.lit("x"))
        return df

    return add
