"""One row per key.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle, so the
copies of a hot key are dropped before they travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First n rows of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row per key; ``order`` should be total for a repeatable choice."""
    return top_per_key(df, keys, [F.col(name).asc_nulls_last() for name in order])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key."""
    return top_per_key(df, keys, [F.col(name).desc_nulls_last() for name in order])
