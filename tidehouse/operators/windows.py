"""Tumbling event-time windows; the same code runs on tables and on watermarked streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehouse.functions.times import second_text

WIDTH = "10 seconds"


def tumble(
    df: DataFrame,
    measures: dict[str, Column],
    dims: Sequence[str] = (),
    ts: str = "ts",
    width: str = WIDTH,
) -> DataFrame:
    """One row per window and ``dims``: stt, edt, dims, measures.

    Measures are aggregates with a partial step, so also a window over all rows sends one row per
    task and window through the shuffle.
    """
    named = [measure.alias(name) for name, measure in measures.items()]
    return (
        df.groupBy(F.window(ts, width).alias("w"), *dims)
        .agg(*named)
        .select(
            second_text(F.col("w.start")).alias("stt"),
            second_text(F.col("w.end")).alias("edt"),
            *dims,
            *measures,
        )
    )


def tumble_sums(
    df: DataFrame, names: Sequence[str], dims: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    return tumble(df, {name: F.sum(name) for name in names}, dims, ts)
