"""Reproducible train/test assignment (declared in the reference's
configuration: test share 0.2, seed 42; the semantics are ours)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.keys import hash_bucket

# The declared split parameters.
TEST_SIZE = 0.2
RANDOM_STATE = 42


def train_test_split(df: DataFrame, key: str, test_size: float = TEST_SIZE, seed: int = RANDOM_STATE) -> DataFrame:
    """DEC-1: ``is_test`` from a hash of (seed, key): the same row lands in
    the same split whatever the partitioning (unlike ``randomSplit``)."""
    if not 0 <= test_size <= 1:
        raise ValueError("test_size must be in [0, 1]")
    return df.withColumn("is_test", hash_bucket(key, seed, 100) < F.lit(round(test_size * 100)))
