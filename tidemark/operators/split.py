"""Deterministic train/test split.

A row's side is a function of (seed, key) only, so the split is disjoint,
complete and identical under any partitioning, retry or re-plan.  The share
is ~``test_fraction`` (a Bernoulli draw per row, not an exact count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import KEY_COL, SPLIT_SEED, TEST_FRACTION
from ..functions.hashing import hash_uniform


def split_expr(key: str = KEY_COL, seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION):
    return F.when(hash_uniform(seed, key, "split") < F.lit(test_fraction), "test").otherwise("train")


def assign_split(df: DataFrame, key: str = KEY_COL, seed: int = SPLIT_SEED,
                 test_fraction: float = TEST_FRACTION) -> DataFrame:
    return df.withColumn("split", split_expr(key, seed, test_fraction))


def train_test(df: DataFrame, key: str = KEY_COL, seed: int = SPLIT_SEED,
               test_fraction: float = TEST_FRACTION) -> tuple[DataFrame, DataFrame]:
    s = split_expr(key, seed, test_fraction)
    return df.filter(s == "train"), df.filter(s == "test")


def split_sizes(df: DataFrame, key: str = KEY_COL) -> DataFrame:
    return assign_split(df.select(key), key).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
