"""Streaming jobs whose state is a table: each micro-batch brings the tables' own rules up to date.

The rules are the batch functions of ``operators`` and ``plans``; a micro-batch reads from a bucketed store what its keys need besides
its own rows. So hot keys are cut as on tables, the order of rows inside a batch doesn't matter, what has been sent follows batch by
batch, and a batch costs what it touches, not what came before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidehouse.operators.keyed import first_per_day, newest_per_key
from tidehouse.streaming import changelog, sinks
from tidehouse.streaming.buckets import BucketStore, merged_sums, newest
from tidehouse.streaming.stores import BATCH

DAY_S = 86400
#: Windows older than this, against the newest one, take no more rows.
LATENESS_S = DAY_S
#: Buckets of the windows in reach, a day at most.
WINDOW_BUCKETS = 8


def _unseen(rows: DataFrame, seen: BucketStore, batch_id: int, keys: Sequence[str], ts: str, tie: Sequence[str]) -> DataFrame:
    """First row of each key and day, with ``_day``, without those of earlier batches."""
    fresh = first_per_day(rows, keys, ts, tie).withColumn("_day", F.to_date(ts))
    known = seen.touched(fresh, batch_id)
    if known is None:
        return fresh
    known = known.select(*[F.col(c).alias(f"_seen_{c}") for c in [*keys, "_day"]])
    return fresh.join(known, [F.col(c).eqNullSafe(F.col(f"_seen_{c}")) for c in [*keys, "_day"]], "left_anti")


def seen_store(out: str, keys: Sequence[str]) -> BucketStore:
    """The keys and days that a daily deduplication below ``out`` has sent."""
    return BucketStore(f"{out.rstrip('/')}-seen", [*keys, "_day"])


def first_of_day_writer(out: str, keys: Sequence[str], ts: str = "ts", tie: Sequence[str] = ()) -> sinks.BatchWriter:
    """First row of every key and calendar day, once, in the earliest micro-batch that has one."""
    seen = seen_store(out, keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            found = _unseen(rows, seen, batch_id, keys, ts, tie).select(*batch.columns)
            found.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            done = rows.sparkSession.read.parquet(sinks.batch_folder(out, batch_id))
            seen.append(done.select(*keys, F.to_date(ts).alias("_day")), batch_id)
        finally:
            rows.unpersist()

    return write


def last_day_store(path: str) -> BucketStore:
    """Each user's latest day."""
    return BucketStore(path, ["uid"], newest(["uid"], ["day"]))


def logins_writer(out: str, last: BucketStore, ts: str = "ts", tie: Sequence[str] = (), back_days: int = 8) -> sinks.BatchWriter:
    """Daily logins (uid, ts, back_ct, uu_ct); ``last`` keeps each user's latest day (``last_day_store``)."""
    seen = seen_store(out, ["uid"])

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("uid", ts, *tie).persist()
        try:
            fresh = _unseen(rows, seen, batch_id, ["uid"], ts, tie).select("uid", ts, F.col("_day").alias("day"))
            known = last.touched(fresh, batch_id)
            marked = fresh.withColumn("_new", F.lit(True))
            if known is not None:
                known = newest_per_key(known, ["uid"], ["day"])
                marked = marked.unionByName(known.select("uid", "day").withColumn("_new", F.lit(False)), allowMissingColumns=True)
            # One row for each day of a user in this batch, and at most one from before.
            previous = F.lag("day").over(Window.partitionBy("uid").orderBy("day", "_new"))
            back = F.coalesce(F.datediff("day", previous) >= back_days, F.lit(False)).cast("long")
            found = marked.withColumn("back_ct", back).filter("_new").select("uid", ts, "back_ct", F.lit(1).cast("long").alias("uu_ct"))
            found.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            done = rows.sparkSession.read.parquet(sinks.batch_folder(out, batch_id))
            last.append(done.groupBy("uid").agg(F.max(F.to_date(ts)).alias("day")), batch_id)
            seen.append(done.select("uid", F.to_date(ts).alias("_day")), batch_id)
        finally:
            rows.unpersist()

    return write


def current(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The rows that hold by now: a change log replayed, else what the latest batch with a result for a key wrote for it."""
    rows = spark.read.parquet(out)
    if changelog.KIND in rows.columns:
        return changelog.standing(rows)
    latest = rows.groupBy(*keys).agg(F.max("batch").alias("batch")).toDF(*(f"_{c}" for c in [*keys, "batch"]))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*keys, "batch"]]
    return rows.join(latest, same, "left_semi").select(*[c for c in rows.columns if c != "batch"])


# --- trade ---------------------------------------------------------------------------------------


def with_order(changes: DataFrame) -> DataFrame:
    """Change records with the order they belong to; records of other tables are left out."""
    own = F.when(F.col("table") == "order_info", F.col("data")["id"])
    return changes.withColumn("order_id", F.coalesce(own, F.col("data")["order_id"])).filter("order_id IS NOT NULL")


def order_results(store: str, **options) -> BucketStore:
    """The compacted change log of what ``order_facts_writer`` has sent."""
    return changelog.log_store(f"{store.rstrip('/')}-results", ["order_id"], **options)


def order_facts_writer(
    out: str, store: str, compute: Callable[[DataFrame], DataFrame], ids: Sequence[str] = (), every: int = 8, buckets: int = 128
) -> sinks.BatchWriter:
    """Facts of the orders that a micro-batch touches, as a change log, by a batch function of ``plans.trade`` over their change records.

    An order's records stay: a payment may come days after its order and meets it whole, and a fact goes only when its order's
    records say so. A batch reads the buckets of its orders, so what is kept costs space, not time. Several records of one batch go by
    their own version; of equal versions the later arrival wins if the source gave a sequence.
    """
    rows = BucketStore(store, ["order_id"], every=every, buckets=buckets)
    results = order_results(store, every=every, buckets=buckets)
    return changelog.changes_writer(out, rows, results, lambda every_row: compute(every_row.drop("order_id")), ids, _line())


def _line() -> Column:
    """The order line of a record; a line's newest record may be of another order."""
    data = F.col("data")
    return F.when(F.col("table") == "order_detail", data["id"]).when(F.col("table").startswith("order_detail_"), data["order_detail_id"])


# --- windows -------------------------------------------------------------------------------------


class WindowRule:
    """A window table in mergeable parts.

    ``partial`` gives rows of ``keys`` (``stt`` among them), further ``parts`` columns and ``sums``, which add up; ``finish`` makes the
    table's rows of added-up parts. ``signed`` says that the input is a change log, whose ``partial`` subtracts.
    """

    def __init__(
        self, keys: Sequence[str], sums: Sequence[str], partial: Callable[[DataFrame], DataFrame],
        finish: Callable[[DataFrame], DataFrame] | None = None, parts: Sequence[str] = (), signed: bool = False,
    ) -> None:
        self.keys, self.sums, self.partial, self.parts, self.signed = list(keys), list(sums), partial, list(parts), signed
        self.finish = finish or (lambda rows: rows)


def additive(compute: Callable[[DataFrame], DataFrame], measures: Sequence[str], dims: Sequence[str] = (), signed: bool = False) -> WindowRule:
    """A window table whose measures are sums or counts: parts are rows of the table itself."""

    def partial(rows: DataFrame) -> DataFrame:
        if not signed:
            return compute(rows)
        gone = compute(rows.filter(changelog.sign() < 0)).withColumns({c: -F.col(c) for c in measures})
        return compute(rows.filter(changelog.sign() > 0)).unionByName(gone)

    some = " OR ".join(f"{c} <> 0" for c in measures)
    return WindowRule(["stt", "edt", *dims], measures, partial, (lambda rows: rows.filter(some)) if signed else None, signed=signed)


def _start_s(ts: str | Column, width_s: int) -> Column:
    """The epoch second at which a row's window begins."""
    second = F.unix_seconds(ts)
    return second - F.pmod(second, F.lit(width_s))


def late_folder(out: str) -> str:
    return f"{out.rstrip('/')}-late"


def window_results(out: str, rule: WindowRule, every: int = 8) -> BucketStore:
    """The window table: the latest row of each key; ``_gone`` marks a key without rows."""
    return BucketStore(out, rule.keys, newest(rule.keys, []), every=every, buckets=WINDOW_BUCKETS)


def windows_now(spark: SparkSession, out: str, rule: WindowRule) -> DataFrame:
    """A window table as it is by now."""
    rows = newest_per_key(window_results(out, rule).before(spark), rule.keys, [BATCH])
    return rows.filter("NOT _gone").drop("_gone", BATCH)


def window_writer(
    out: str, store: str, ts: str, rule: WindowRule, lateness_s: int = LATENESS_S, width_s: int = 10, every: int = 8,
    counted: Callable[[int, int], None] | None = None,
) -> sinks.BatchWriter:
    """Windows that a micro-batch touches, from added-up parts; also the last ones of a finished input.

    State is one row for each window, key and part, until the window lies ``lateness_s`` behind the newest one of the batches before.
    Rows that come for a window older than that are not counted but written to ``late_folder(out)``, batch by batch; ``counted`` is
    told their number. Without a time a row belongs to no window.
    """
    parts = BucketStore(
        store, rule.keys, merged_sums([*rule.keys, *rule.parts, "_second"], rule.sums), every=every, time="_second", keep_s=lateness_s,
        buckets=WINDOW_BUCKETS,
    )
    results = window_results(out, rule, every)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, batch.persist()
        try:
            mark = parts.mark(spark, batch_id)
            on_time = rows
            if mark is not None:
                second = _start_s(ts, width_s)
                observed = Observation()
                late = rows.filter(second < mark - lateness_s).observe(observed, F.count(F.lit(1)).alias("n"))
                late.write.mode("overwrite").parquet(sinks.batch_folder(late_folder(out), batch_id))
                if counted:
                    counted(batch_id, observed.get["n"])
                on_time = rows.filter(second >= mark - lateness_s)
            part = rule.partial(on_time).withColumn("_second", F.unix_timestamp("stt")).persist()
            try:
                earlier = parts.touched(part, batch_id)
                every_part = part if earlier is None else part.unionByName(earlier.drop(BATCH))
                sums = [F.sum(c).cast(part.schema[c].dataType).alias(c) for c in rule.sums]
                added = every_part.groupBy(*rule.keys, *rule.parts).agg(*sums)
                table = rule.finish(added).withColumn("_gone", F.lit(False))
                if rule.signed:
                    touched = part.select(*rule.keys).distinct()
                    there = table.select(*[F.col(c).alias(f"_there_{c}") for c in rule.keys])
                    gone = touched.join(there, [F.col(c).eqNullSafe(F.col(f"_there_{c}")) for c in rule.keys], "left_anti")
                    table = table.unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
                results.append(table, batch_id)
                parts.append(part, batch_id)
            finally:
                part.unpersist()
        finally:
            rows.unpersist()

    return write
