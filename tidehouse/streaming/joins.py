"""Regular joins of two streams: every row meets every row of the other side with its key, for as long as each side is kept.

The sides are bucketed stores with a retention of their own. A micro-batch joins its new left rows with all right ones and the
older left rows with its new right ones, so no pair is made twice and a hot key costs its new pairs only. The result is a change log: in a left,
right or full join a row without partner is sent with nulls at once, and taken back when its first partner comes. Which rows stand with nulls
is kept in a log of its own, so a partner that has expired meanwhile does not bring the nulls back.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehouse.operators.intervals import interval_join
from tidehouse.operators.lookup import spread_join
from tidehouse.streaming import changelog, sinks
from tidehouse.streaming.buckets import BucketStore
from tidehouse.streaming.changelog import KIND
from tidehouse.streaming.incremental import late_folder
from tidehouse.streaming.stores import BATCH, Folder

LEFT, RIGHT = "_left", "_right"


@dataclass(frozen=True)
class Side:
    """``time``: epoch seconds of a row; it meets the other side's rows until it lies ``keep_s`` behind the newest row of both sides
    in earlier batches (None: for ever)."""

    time: str
    keep_s: int | None = None


def two_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both streams as one, each row in the column of its side."""
    return left.select(F.struct(*left.columns).alias(LEFT)).unionByName(right.select(F.struct(*right.columns).alias(RIGHT)), allowMissingColumns=True)


def _keys(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that can meet: none of their columns is null."""
    out = rows.select(*on)
    for c in on:
        out = out.filter(F.col(c).isNotNull())
    return out.distinct()


def _kept(earlier: DataFrame | None, like: DataFrame) -> DataFrame:
    return like.limit(0) if earlier is None else earlier.select(*like.columns)


def regular_join_writer(
    out: str, store: str, on: Sequence[str], how: str, left: Side, right: Side, every: int = 8, buckets: int = 128
) -> sinks.BatchWriter:
    """Batches of ``two_sides``; writes the changes of the join (``kind``, the keys, then both sides' other columns, which need
    different names)."""
    on = list(on)
    sides = {LEFT: left, RIGHT: right}
    options = {"every": every, "buckets": buckets}
    rows = {s: BucketStore(f"{store}/rows{s}", on, time=side.time, keep_s=side.keep_s, **options) for s, side in sides.items()}
    outer = [s for s in (LEFT, RIGHT) if how == "full" or s == f"_{how}"]
    alone = {s: changelog.log_store(f"{store}/alone{s}", on, time=sides[s].time, keep_s=sides[s].keep_s, **options) for s in outer}

    def pairs(facts: DataFrame, others: DataFrame) -> DataFrame:
        """Hot keys of ``facts`` are cut; a hot key of the others is left to adaptive execution."""
        return spread_join(facts, others, on, [c for c in facts.columns if c not in on], "inner")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, batch.persist()
        try:
            new = {s: held.filter(F.col(s).isNotNull()).select(f"{s}.*") for s in sides}
            far = {LEFT: RIGHT, RIGHT: LEFT}
            old = {s: _kept(rows[s].touched(_keys(new[far[s]], on), batch_id), new[s]) for s in sides}
            columns = [*on, *[c for s in sides for c in new[s].columns if c not in on]]
            every_right = new[RIGHT].unionByName(old[RIGHT])
            log = pairs(new[LEFT], every_right).unionByName(pairs(new[RIGHT], old[LEFT]).select(*columns)).select(*columns)
            log = log.withColumn(KIND, F.lit("+I"))
            marks = {}
            for s in outer:
                others = new[far[s]].unionByName(old[far[s]])
                lonely = new[s].join(_keys(others, on), on, "left_anti").withColumn(KIND, F.lit("+I"))
                before = alone[s].touched(_keys(new[far[s]], on), batch_id)
                if before is not None:
                    lonely = lonely.unionByName(changelog.replayed(before).withColumn(KIND, F.lit("-D")).select(*lonely.columns))
                marks[s] = lonely
                log = log.unionByName(lonely, allowMissingColumns=True)
            log.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            times = [F.max(F.col(f"{s}.{side.time}")) for s, side in sides.items()]
            newest = max((t for t in held.agg(*times).first() if t is not None), default=None)
            for s in outer:
                alone[s].append(marks[s], batch_id, newest)
            for s in sides:
                rows[s].append(new[s], batch_id, newest)
        finally:
            held.unpersist()

    return write


def joined(spark, out: str) -> DataFrame:
    """The join as it stands by now."""
    return changelog.table(spark, out).drop(BATCH)


# --- rows near in time -------------------------------------------------------------------------------


def interval_join_writer(
    out: str, store: str, on: Sequence[str], left_ts: str, right_ts: str, keep_s: int = 5, how: str = "full", delay_s: int = 0
) -> sinks.BatchWriter:
    """Batches of ``two_sides``; writes pairs at most ``keep_s`` apart when the later row comes, and the lonely rows of an outer side,
    with nulls and once, when the mark has passed all possible partners.

    The mark is ``delay_s`` behind the newest time that both sides have reached; rows older than it are set apart in
    ``incremental.late_folder(out)``. What may still be needed waits in ``store``. Both sides are cut into time slices, also in right and full joins:
    whether a row is lonely is asked by its key and time, not by its copies in slices, so a hot key is spread over its slices.
    Rows without a time are left out.
    """
    on, keep = list(on), keep_s * 1000
    times = {LEFT: left_ts, RIGHT: right_ts}
    outer = [s for s in times if how == "full" or s == f"_{how}"]
    waiting = f"{store}/waiting"

    def near(left: DataFrame, right: DataFrame) -> DataFrame:
        renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns if c not in on})
        found = interval_join(left, renamed, on, left_ts, f"_r_{right_ts}", -keep_s, keep_s)
        return found.withColumnsRenamed({f"_r_{c}": c for c in right.columns if c not in on})

    def lonely(rows: DataFrame, side: str, others: DataFrame) -> DataFrame:
        """Rows whose key and time have no partner among the others."""
        ts, other_ts = times[side], times[RIGHT if side == LEFT else LEFT]
        moments = rows.select(*on, F.col(ts).alias("_ts")).distinct()
        there = others.select(*on, F.col(other_ts).alias("_other")).distinct()
        met = interval_join(moments, there, on, "_ts", "_other", -keep_s, keep_s).select(*[F.col(c).alias(f"_met_{c}") for c in [*on, "_ts"]]).distinct()
        same = [F.col(c) == F.col(f"_met_{c}") for c in on] + [F.col(ts) == F.col("_met__ts")]
        return rows.join(met, same, "left_anti")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, batch.persist()
        try:
            ms = {s: F.unix_millis(F.col(f"{s}.{ts}")) for s, ts in times.items()}
            either = F.coalesce(ms[LEFT], ms[RIGHT])
            marks = Folder(spark, store)
            text = marks.text(f"_mark-{batch_id - 1}") if batch_id else None
            before = json.loads(text) if text else [None, None]
            limit = None if None in before else min(before) - delay_s * 1000
            fresh = held.filter(either.isNotNull())
            if limit is not None:
                late = fresh.filter(either < limit)
                late.write.mode("overwrite").parquet(sinks.batch_folder(late_folder(out), batch_id))
                fresh = fresh.filter(either >= limit)
            old = spark.read.schema(held.schema).parquet(sinks.batch_folder(waiting, batch_id - 1)) if batch_id else fresh.limit(0)
            rows = {s: fresh.filter(F.col(s).isNotNull()).select(f"{s}.*") for s in times}
            kept = {s: old.filter(F.col(s).isNotNull()).select(f"{s}.*") for s in times}
            every = {s: rows[s].unionByName(kept[s]) for s in times}
            found = near(rows[LEFT], every[RIGHT]).unionByName(near(kept[LEFT], rows[RIGHT]))
            newest = [max((t for t in pair if t is not None), default=None) for pair in zip(before, held.agg(*[F.max(m) for m in ms.values()]).first())]
            now = None if None in newest else min(newest) - delay_s * 1000
            if now is not None:
                for s in outer:
                    own = F.unix_millis(times[s])
                    done = every[s].filter(own + keep < now)
                    if limit is not None:
                        done = done.filter(own + keep >= limit)
                    found = found.unionByName(lonely(done, s, every[RIGHT if s == LEFT else LEFT]), allowMissingColumns=True)
            found.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            still = fresh.unionByName(old)
            if now is not None:
                # A row that may be lonely needs its partners, which are as old as it is and ``keep`` more.
                still = still.filter(either >= now - 2 * keep)
            still.write.mode("overwrite").parquet(sinks.batch_folder(waiting, batch_id))
            marks.create(f"_mark-{batch_id}", json.dumps(newest), replace=True)
            folder = Folder(spark, waiting)
            for name in folder.names():
                if name.startswith("batch=") and int(name[6:]) < batch_id - 1:
                    folder.remove(name)
            for name in marks.names():
                if name.startswith("_mark-") and int(name[6:]) < batch_id - 1:
                    marks.remove(name)
        finally:
            held.unpersist()

    return write
