"""Selecting records of one table from the change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehouse.functions.values import as_int
from tidehouse.schemas import CHANGE_INSERT, CHANGE_UPDATE, DATABASE


def changes_of(
    changes: DataFrame,
    table: str,
    types: Sequence[str] | None = None,
    database: str | None = DATABASE,
) -> DataFrame:
    """Records of ``table``, optionally of some change types only."""
    keep = F.col("table") == table
    if database is not None:
        keep = keep & (F.col("database") == database)
    if types is not None:
        keep = keep & F.col("type").isin(*types)
    return changes.filter(keep)


def moved_to(column: str, value: str) -> Column:
    """Update that touched ``column`` and left it at ``value``."""
    return (
        (F.col("type") == CHANGE_UPDATE)
        & F.col("old")[column].isNotNull()
        & (F.col("data")[column] == value)
    )


def increase(column: str) -> Column:
    """New amount of an insert, added amount of an update."""
    new, old = as_int(F.col("data")[column]), as_int(F.col("old")[column])
    return F.when(F.col("type") == CHANGE_INSERT, new).otherwise(new - old)


def increased(column: str) -> Column:
    """Insert, or update that raised ``column``."""
    new, old = as_int(F.col("data")[column]), as_int(F.col("old")[column])
    return (F.col("type") == CHANGE_INSERT) | ((F.col("type") == CHANGE_UPDATE) & (new > old))
