"""Per-key first n, global last n, and the has-data probe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key by ``order``.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most ``n`` rows per key: a hot
    key costs n x tasks rows in its final sort, not all of its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def last_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The last ``n`` rows by ``order`` (given descending), newest first (TakeOrdered)."""
    return df.orderBy(*order).limit(n)


def has_data(df: DataFrame) -> DataFrame:
    """One row: whether ``df`` has at least one row (reads at most one)."""
    return df.limit(1).select((F.count(F.lit(1)) > 0).alias("has_data"))
