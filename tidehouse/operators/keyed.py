"""One row per key: newest version, first visit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _top_row(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    # Spark turns "row_number() = 1" into a per-task group limit before the shuffle, so a key
    # that holds a third of all rows sends one row per map task, not all of its rows.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def newest_per_key(
    df: DataFrame, keys: Sequence[str | Column], version: Sequence[str]
) -> DataFrame:
    """The row with the largest ``version`` columns of every key.

    Where the rows carry ``seq``, the order of arrival, it decides between rows that are equal in
    the first version column, before the others do.
    """
    order = list(version)
    if "seq" in df.columns and order and "seq" not in order:
        order.insert(1, "seq")
    return _top_row(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], version: Sequence[str]
) -> DataFrame:
    """The row with the smallest ``version`` columns of every key."""
    return _top_row(df, keys, [F.col(c).asc_nulls_last() for c in version])


def first_per_day(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", tie: Sequence[str] = ()
) -> DataFrame:
    """First row of every key and calendar day of ``ts`` (daily deduplication)."""
    return first_per_key(df, [*keys, F.to_date(F.col(ts))], [ts, *tie])
