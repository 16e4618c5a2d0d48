from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

CLASHING = (
    "n_tokens n_bytes fingerprint component_id component chunk bucket row n_words n_hit spans"
    " base held_out score predicted lang_pred segment place start ids n_email flip key middle"
).split()


def framed(spark, rows, schema="doc_id long, text string"):
    """Rows as a table with further columns, named like those that operators make."""
    df = spark.createDataFrame(rows, schema)
    return df.select(
        "*", *(F.lit("own").alias(c) for c in CLASHING if c not in df.columns)
    )


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, repeated, very long and unusual texts."""
    rng = random.Random(11)
    letters = list(" \n\t\r 　\x1f'") + [
        "a", "b", "é", "1", "²", "-", "漢", "\U0001f642", "'s", "<|endoftext|>", ".",
        "  ", "́", "B", "Á",
    ]
    noise = [
        (100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))))
        for i in range(300)
    ]
    return [
        (1, "the quick brown fox jumps over the lazy dog"),
        (2, "The QUICK brown fox jumps over the lazy dog"),
        (2, "The QUICK brown fox jumps over the lazy dog"),
        (3, None), (None, None), (None, "a text without an id"), (4, ""), (5, " \n\t "),
        (6, "word " * 60_000), (7, "a" * 100_000), (8, "one"), (-9, "two words"),
        *noise,
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return framed(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return framed(spark, [])
