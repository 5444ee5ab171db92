"""Event-time neighbours: range join of two streams, and the next event of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower_s: int,
    upper_s: int,
) -> DataFrame:
    """Inner join on ``on`` where right_ts lies in [left_ts + lower_s, left_ts + upper_s].

    Both sides are cut into time slices as wide as the range: a left row is in one slice, a right
    row in the at most two slices whose left rows it can meet. A key with very many rows is thus
    spread over its slices, and only neighbours in time are compared.
    """
    width = max((upper_s - lower_s) * SECOND, 1)
    left_us, right_us = F.unix_micros(left_ts), F.unix_micros(right_ts)
    first = F.floor((right_us - F.lit(upper_s * SECOND)) / F.lit(width))
    last = F.floor((right_us - F.lit(lower_s * SECOND)) / F.lit(width))
    sliced_left = left.withColumn("_slice", F.floor(left_us / F.lit(width)))
    sliced_right = right.withColumn("_slice", F.explode(F.sequence(first, last)))
    near = F.unix_micros(right_ts) - F.unix_micros(left_ts)
    return (
        sliced_left.join(sliced_right, [*on, "_slice"])
        .filter(near.between(lower_s * SECOND, upper_s * SECOND))
        .drop("_slice")
    )


def bounced_entries(
    pages: DataFrame,
    key: str = "mid",
    ts: str = "ts",
    tie: Sequence[str] = (),
    within_s: int = 10,
    slice_s: int = 60,
) -> DataFrame:
    """Entry pages (no previous page) that were not followed by another page in time.

    An entry page bounces when the key's next event is again an entry page, or comes ``within_s``
    seconds later or more, or never. Whatever happens after ``within_s`` does not matter, so a key
    is cut into slices of ``slice_s`` seconds; the first ``within_s`` seconds of a slice are also
    shown to the slice before. No task has to order the whole history of one key.
    """
    within, width = within_s * SECOND, slice_s * SECOND
    us = F.unix_micros(ts)
    own = F.floor(us / F.lit(width))
    seen_in = F.when(us - own * width < within, F.array(own, own - 1)).otherwise(F.array(own))
    is_entry = F.col("last_page_id").isNull()
    in_slice = Window.partitionBy(key, "_slice").orderBy("_us", *tie)
    sliced = (
        pages.withColumns({"_us": us, "_own": own})
        .withColumn("_slice", F.explode(seen_in))
        .withColumns(
            {
                "_next_us": F.lead("_us").over(in_slice),
                "_next_entry": F.lead(is_entry).over(in_slice),
            }
        )
    )
    left_alone = F.col("_next_us").isNull() | (F.col("_next_us") - F.col("_us") >= within)
    return sliced.filter(
        is_entry & (F.col("_slice") == F.col("_own")) & (left_alone | F.col("_next_entry"))
    ).drop("_us", "_own", "_slice", "_next_us", "_next_entry")
