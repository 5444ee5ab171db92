"""Detail layer of the application log: unique visitors and bounces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehouse.operators.intervals import bounced_entries
from tidehouse.operators.keyed import first_per_day


def entry_pages(pages: DataFrame) -> DataFrame:
    """Page views that start a session."""
    return pages.filter(F.col("last_page_id").isNull())


def unique_visitors(pages: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """First session entry of every (mid, day)."""
    return first_per_day(entry_pages(pages), ["mid"], "ts", tie)


def user_jumps(pages: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Session entries that were left without a second page within ten seconds."""
    return bounced_entries(pages, "mid", "ts", tie)
