"""Keyed state that lasts longer than any window, with Spark's own operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_of_day_stream(
    df: DataFrame, keys: list[str], ts: str = "ts", parts: int = 1
) -> DataFrame:
    """One arrival of every key and calendar day; of a micro-batch's rows any may be the one kept.

    Where it matters which row is kept, use ``incremental.first_of_day_writer``.

    The day is part of the key, so repeats of a key are less than a day apart. A watermark of one
    day therefore keeps a key long enough, and lets Spark forget it afterwards; rows are sent on at
    once, the delay only concerns the state. With ``parts`` above one, a key is first deduplicated
    in that many parts, so that a visitor with a third of all rows does not meet one task.
    """
    daily = df.withColumn("_day", F.to_date(ts)).withWatermark(ts, "1 day")
    if parts > 1:
        part = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(parts))
        daily = (
            daily.withColumn("_part", part)
            .dropDuplicatesWithinWatermark([*keys, "_day", "_part"])
            .drop("_part")
        )
    return daily.dropDuplicatesWithinWatermark([*keys, "_day"]).drop("_day")
