"""Joins that bring one dimension row to each fact row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Files behind a dimension that is broadcast; a few times as much in memory.
MAX_BROADCAST_BYTES = 24 << 20
# Where the size of a source is unknown, this many rows count instead.
MAX_BROADCAST_ROWS = 100_000
# A join task should not see more rows of one key than this.
ROWS_PER_TASK = 2_000_000
_UNKNOWN = 1 << 60


def source_bytes(df: DataFrame) -> int:
    """Bytes of all sources a table is made of, as the planner knows them; runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a static table may be broadcast: by the bytes of its sources, or counted if unknown."""
    size = source_bytes(df)
    return size <= MAX_BROADCAST_BYTES if size < _UNKNOWN else df.count() <= max_rows


def hot_keys(
    facts: DataFrame, on: Sequence[str], rows_per_task: int | None = None
) -> DataFrame:
    """Keys with more rows than one task should take, and the number of parts to cut them into.

    At most ``rows of facts / rows_per_task`` keys can pass, which bounds the broadcast; without a
    value ``ROWS_PER_TASK`` counts.
    """
    limit = rows_per_task or ROWS_PER_TASK
    parts = F.ceil(F.col("_n") / F.lit(limit)).cast("int")
    return (
        facts.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > limit)
        .select(*on, parts.alias("_parts"))
    )


def spread_join(
    facts: DataFrame,
    rows: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Shuffle join (inner or left) in which a hot key of ``facts`` is cut into parts.

    The part of a fact row is a hash of ``spread_by`` (repeatable when a task is run again); only
    the hot keys' ``rows`` are copied, once per part. Fact rows without a key match nothing and
    are spread as well. ``hot`` may come from a cheaper source that holds at least as many rows
    per key; both sides are shuffled on (key, part), so adaptive execution can still split a hot
    key of ``rows``.
    """
    if how not in ("inner", "left"):
        raise ValueError("copied rows would be repeated; see regular_join for right and full")
    hot = F.broadcast(hot if hot is not None else hot_keys(facts, on, rows_per_task))
    has_key = F.lit(True)
    for name in on:
        has_key = has_key & F.col(name).isNotNull()
    parts = F.when(has_key, F.coalesce(F.col("_parts"), F.lit(1))).otherwise(F.lit(1024))
    left = (
        facts.join(hot, list(on), "left")
        .withColumn("_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
        .drop("_parts")
    )
    right = (
        rows.join(hot, list(on), "left")
        .withColumn(
            "_part",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - F.lit(1))),
        )
        .drop("_parts")
    )
    return left.join(right, [*on, "_part"], how).drop("_part")


def regular_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str
) -> DataFrame:
    """Inner, left, right or full join on equal keys with hot keys of ``left`` cut into parts.

    Right rows without partner are found against the distinct left keys and added.
    """
    joined = spread_join(left, right, on, spread_by, "left" if how in ("left", "full") else "inner")
    if how in ("right", "full"):
        lonely = right.join(left.select(*on).distinct(), list(on), "left_anti")
        joined = joined.unionByName(lonely, allowMissingColumns=True)
    return joined


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Facts with their dimension row; ``dimension`` has at most one row per key.

    A dimension counted as small is broadcast; a larger one is joined through a shuffle with the
    hot fact keys cut into parts. ``small`` passes on a count already made.
    """
    if is_small(dimension) if small is None else small:
        return facts.join(F.broadcast(dimension), list(on), how)
    if facts.isStreaming:
        return facts.join(dimension, list(on), how)
    return spread_join(facts, dimension, on, spread_by, how)


def code_names(dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Dictionary with its code and name columns renamed for a ``lookup``."""
    return dictionary.select(F.col("dic_code").alias(code), F.col("dic_name").alias(name))
