"""Sequence patterns over the events of a key: begin, next, next..., all within a span; matches and timeouts apart.

A pattern is tried at every event that fits its first step. The following events of the key must fit the further steps one by one,
without another event between them, each less than the span after the first. If the next event is missing or comes too late, the
attempt times out with the steps it has; if it comes in time and doesn't fit, the attempt is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidehouse.operators.intervals import SECOND

MATCH, TIMEOUT = "match", "timeout"


@dataclass(frozen=True)
class Pattern:
    """Names and conditions of the steps, in order, and the span in seconds."""

    steps: tuple[tuple[str, Column], ...]
    within_s: int

    @staticmethod
    def begin(name: str, fits: Column, within_s: int) -> Pattern:
        return Pattern(((name, fits),), within_s)

    def next(self, name: str, fits: Column) -> Pattern:
        return Pattern((*self.steps, (name, fits)), self.within_s)


def matched(
    events: DataFrame, pattern: Pattern, key: str, ts: str, tie: Sequence[str] = (), carried: Sequence[str] = (), slice_s: int = 60
) -> DataFrame:
    """The events that begin an attempt, with ``outcome`` (match or timeout), ``reached`` (steps that fit) and, for every step reached, a
    struct by its name of the ``carried`` columns.

    What lies a span or more ahead does not matter, so a key is cut into slices of ``slice_s`` seconds that also see the first span of
    the next one; no task orders a key's whole history. Conditions are asked once for each event. Events without a time are left out.
    """
    span, width = pattern.within_s * SECOND, max(slice_s, pattern.within_s) * SECOND
    us = F.unix_micros(ts)
    own = F.floor(us / F.lit(width))
    seen_in = F.when(us - own * width < span, F.array(own, own - 1)).otherwise(F.array(own))
    shown = F.struct(*[F.col(c) for c in carried]) if carried else F.struct(F.col(ts))
    facts = events.filter(F.col(ts).isNotNull()).withColumns({"_us": us, "_own": own, "_shown": shown})
    facts = facts.withColumns({f"_fits{k}": F.coalesce(fits, F.lit(False)) for k, (_, fits) in enumerate(pattern.steps)})
    in_slice = Window.partitionBy(key, "_slice").orderBy("_us", *tie)
    ahead = {}
    for k in range(1, len(pattern.steps)):
        ahead |= {f"_us{k}": F.lead("_us", k).over(in_slice), f"_ok{k}": F.lead(f"_fits{k}", k).over(in_slice), f"_shown{k}": F.lead("_shown", k).over(in_slice)}
    tried = facts.withColumn("_slice", F.explode(seen_in)).withColumns(ahead).filter((F.col("_slice") == F.col("_own")) & F.col("_fits0"))
    # Step by step: how far the attempt has come, and whether it still goes on.
    reached, outcome = F.lit(1), F.lit(None).cast("string")
    for k in range(1, len(pattern.steps)):
        in_time = F.coalesce(F.col(f"_us{k}") - F.col("_us") < span, F.lit(False))
        open_ = outcome.isNull()
        step = F.when(~in_time, F.lit(TIMEOUT)).when(~F.col(f"_ok{k}"), F.lit("dropped"))
        reached = F.when(open_ & step.isNull(), reached + 1).otherwise(reached)
        outcome = F.when(open_, step).otherwise(outcome)
    done = tried.withColumns({"outcome": F.coalesce(outcome, F.lit(MATCH)), "reached": reached}).filter("outcome <> 'dropped'")
    steps = [F.when(F.col("reached") > k, F.col(f"_shown{k}" if k else "_shown")).alias(name) for k, (name, _) in enumerate(pattern.steps)]
    return done.select(*events.columns, "outcome", "reached", *steps)


def bounces(entry: Column, within_s: int = 10) -> Pattern:
    """An entry that another entry follows, or nothing in time: a bounce is a match or a timeout."""
    return Pattern.begin("entry", entry, within_s).next("again", entry)
