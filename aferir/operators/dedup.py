"""Keep-first, latest-per-key and distinct.

``row_number() == 1`` is planned with a map-side group limit: each input partition keeps one row per
key before the shuffle, so a key that holds a large share of all rows sends one row per partition,
not all its rows, to the task that picks the winner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order (null keys form a group too)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def any_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; ordered by all columns so that reruns pick the same row.

    Equal rows are merged by hash first, which is what shrinks a table that repeats its keys.
    """
    rest = sorted(c for c in df.columns if c not in keys)
    return keep_first(df.distinct(), keys, rest) if rest else df.distinct()


def latest_per_key(
    df: DataFrame, keys: Sequence[str], year: str, order: Sequence[str | Column] = ()
) -> DataFrame:
    """The row of the most recent year of every key."""
    return keep_first(df, keys, [F.col(year).desc(), *order])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
