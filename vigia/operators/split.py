"""Reproducible train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_bucket(key: Column, seed: int = 42) -> Column:
    """Number 0-99 that depends on the key and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(100)).cast("int")


def hash_split(
    df: DataFrame, key: str, train_percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key.

    ``randomSplit`` draws per partition, so its parts change with the number of partitions and may
    even differ between two runs of one plan.  These parts never do; rows with equal keys stay
    together, and a row with a NULL key goes to train.
    """
    bucket = F.coalesce(split_bucket(F.col(key), seed), F.lit(0))
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)
