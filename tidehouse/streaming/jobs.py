"""Streaming forms of the detail and window layers.

Hops are separate queries joined by topics, so each has its own watermark and can be restarted on
its own: the daily deduplications keep state for a day, the windows behind them close after
seconds. The window functions themselves are those of ``plans.metrics``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.operators.intervals import SECOND, bounced_entries
from tidehouse.operators.lookup import code_names, lookup
from tidehouse.operators.visits import new_visitor_days, with_true_flag
from tidehouse.plans import metrics, traffic, trade
from tidehouse.streaming import sinks
from tidehouse.streaming import incremental
from tidehouse.streaming.buckets import BucketStore
from tidehouse.streaming.stores import Folder

DELAY = "2 seconds"
TRAFFIC_DELAY = "13 seconds"


# --- traffic -----------------------------------------------------------------------------------


def unique_visitors_writer(out: str, tie: Sequence[str] = ()) -> sinks.BatchWriter:
    """First session entry per visitor and day; batches are of ``traffic.entry_pages``."""
    return incremental.first_of_day_writer(out, ["mid"], tie=tie)


def user_jumps_writer(
    out: str, pending: str, tie: Sequence[str] = (), within_s: int = 10, delay_s: int = 2
) -> sinks.BatchWriter:
    """Bounced session entries, written per micro-batch below ``out``.

    Whether an entry bounced is settled once the event-time mark (latest time seen less
    ``delay_s``) is ``within_s`` past it. Until then its pages wait in ``pending`` and join the
    next micro-batch; rows older than the mark come too late and are dropped. The rule itself is
    the table's, so also here a busy visitor is cut into time slices and nothing is gathered into
    lists. A repeated micro-batch reads the same pending pages and replaces its own folders.
    """
    within, delay = within_s * SECOND, delay_s * SECOND
    us = F.unix_micros("ts")

    def latest(rows: DataFrame) -> int | None:
        return rows.agg(F.max(us)).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, before = batch, None
        if batch_id > 0:
            waiting = batch.sparkSession.read.parquet(sinks.batch_folder(pending, batch_id - 1))
            seen = latest(waiting)
            if seen is not None:
                before = seen - delay
                rows = waiting.unionByName(batch.filter(us >= before))
                late = batch.filter(us < before)
                late.write.mode("overwrite").parquet(sinks.batch_folder(incremental.late_folder(out), batch_id))
        rows = rows.persist()
        try:
            seen = latest(rows)
            now = None if seen is None else seen - delay
            settled = F.lit(False) if now is None else us <= now - within
            if before is not None:
                settled = settled & (us > before - within)
            open_rows = rows if now is None else rows.filter(us > now - within)
            found = bounced_entries(rows, "mid", "ts", tie, within_s).filter(settled)
            found.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            open_rows.write.mode("overwrite").parquet(sinks.batch_folder(pending, batch_id))
            # A repeated batch reads the pages of the one before it; older ones are settled.
            folder = Folder(batch.sparkSession, pending)
            for name in folder.names():
                if name.startswith("batch=") and int(name[6:]) < batch_id - 1:
                    folder.remove(name)
        finally:
            rows.unpersist()

    return write


def new_visitor_writer(out: str, known: str, tie: Sequence[str] = (), every: int = 8) -> sinks.BatchWriter:
    """Corrected new-visitor flags per micro-batch, with the new days in a table.

    The first micro-batch that has a visitor decides, by its first record in event time. A busy
    visitor is cut as on tables. Of the known days only the buckets of the batch's visitors are read.
    """
    store = BucketStore(known, ["mid"], every=every)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            fresh = new_visitor_days(rows, "ts", tie)
            earlier = store.touched(rows, batch_id)
            days = fresh
            if earlier is not None:
                earlier = earlier.select("mid", "new_day").persist()
                fresh = fresh.join(earlier.select(F.col("mid").alias("_mid")), F.col("mid").eqNullSafe(F.col("_mid")), "left_anti")
                days = fresh.unionByName(earlier)
            fixed = with_true_flag(rows, days, "ts", tie)
            fixed.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            store.append(fresh, batch_id)
            if earlier is not None:
                earlier.unpersist()
        finally:
            rows.unpersist()

    return write


def page_view_window_stream(
    pages: DataFrame, visitors: DataFrame, jumps: DataFrame, delay: str = TRAFFIC_DELAY
) -> DataFrame:
    """Traffic counters; the watermark is set on the union of the three streams."""
    union = metrics.traffic_union(pages, visitors, jumps)
    return metrics.page_view_window(union.withWatermark("ts", delay))


def keyword_window_stream(pages: DataFrame, delay: str = DELAY) -> DataFrame:
    words = metrics.keyword_words(metrics.search_keywords(metrics.whole_second_pages(pages)))
    return metrics.keyword_window(words.withWatermark("ts", delay))


def home_and_detail(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("page_id").isin(S.PAGE_HOME, S.PAGE_DETAIL))


def home_detail_visits_writer(out: str, tie: Sequence[str] = ()) -> sinks.BatchWriter:
    """First daily visit of the home and the detail page per visitor."""
    return incremental.first_of_day_writer(out, ["mid", "page_id"], tie=tie)


def home_detail_window_stream(first_visits: DataFrame, delay: str = DELAY) -> DataFrame:
    return metrics.home_detail_window(first_visits.withWatermark("ts", delay))


def known_entries(pages: DataFrame) -> DataFrame:
    return traffic.entry_pages(pages).filter(F.col("uid").isNotNull())


def user_logins_writer(out: str, last: str, tie: Sequence[str] = ()) -> sinks.BatchWriter:
    """Daily logins; each user's last day is kept below ``last``. Batches are of ``known_entries``."""
    return incremental.logins_writer(out, incremental.last_day_store(last), tie=tie)


def user_login_window_stream(daily: DataFrame, delay: str = DELAY) -> DataFrame:
    return metrics.user_login_window(daily.withWatermark("ts", delay))


# --- carts and registrations ---------------------------------------------------------------------


def cart_first_of_day_writer(out: str, tie: Sequence[str] = ()) -> sinks.BatchWriter:
    """First cart addition per user and day; batches are of ``metrics.with_cart_time``."""
    return incremental.first_of_day_writer(out, ["user_id"], "event_ts", tie)


def cart_user_window_stream(first_additions: DataFrame, delay: str = DELAY) -> DataFrame:
    return metrics.cart_user_window(first_additions.withWatermark("event_ts", delay))


def register_window_stream(registered: DataFrame, delay: str = DELAY) -> DataFrame:
    timed = registered.withColumn("event_ts", F.timestamp_seconds("ts"))
    counted = timed.withWatermark("event_ts", delay)
    return metrics.tumble(counted, {"register_ct": F.count(F.lit(1))}, ts="event_ts")


# --- trade -----------------------------------------------------------------------------------------


def _seconds(span: str) -> int:
    """Whole seconds of a span such as ``5 seconds`` or ``3 days``."""
    count, unit = span.split()
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(count) * sizes[unit.rstrip("s")]


def _near(left: str, right: str, keep: str) -> Column:
    span = F.expr(f"INTERVAL {keep}")
    return F.col(right).between(F.col(left) - span, F.col(left) + span)


def interval_join_stream(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    keep: str = "5 seconds",
    how: str = "inner",
    *,
    delay: str,
) -> DataFrame:
    """Join of two streams on ``on`` and at most ``keep`` apart; state goes with the watermark.

    ``how`` may also be left, right or full: a row without partner is sent on once, with nulls,
    when no partner can come any more. Rows more than ``delay`` behind the newest are dropped.

    A key is cut into time slices, as in ``operators.intervals``: a left row is in one slice, a
    right row is shown to the slices whose left rows it can meet, so a busy key is spread over its
    slices. With right and full joins a right row must stay single, and the key is not cut.
    """
    a = left.withWatermark(left_ts, delay).alias("a")
    b = right.withColumnRenamed(on, f"_{on}").withWatermark(right_ts, delay)
    same = (F.col(on) == F.col(f"_{on}")) & _near(left_ts, right_ts, keep)
    if how in ("right", "full"):
        return a.join(b.alias("b"), same, how)
    span = 2 * _seconds(keep) * SECOND
    right_us = F.unix_micros(right_ts)
    first, last = (F.floor((right_us + F.lit(side * span // 2)) / F.lit(span)) for side in (-1, 1))
    a = left.withColumn("_slice", F.floor(F.unix_micros(left_ts) / F.lit(span))).withWatermark(left_ts, delay).alias("a")
    b = b.withColumn("_right_slice", F.explode(F.sequence(first, last))).alias("b")
    joined = a.join(b, same & (F.col("_slice") == F.col("_right_slice")), how)
    return joined.drop("_slice", "_right_slice")


def order_detail_stream(
    changes: DataFrame, dictionary: DataFrame, keep: str = "3 days", delay: str = "3 days"
) -> DataFrame:
    """Order lines joined with header, activity and coupon that come within ``keep``.

    Rows may come ``delay`` late. ``incremental.order_facts_writer`` is the other form: it keeps
    its state in a table, cuts hot orders and corrects what was written.

    Activities and coupons are optional: when none came in time, the line is sent on once with
    nulls. The dictionary is joined as a table.
    """
    def timed(rows: DataFrame, seconds: str, name: str) -> DataFrame:
        stamp = F.timestamp_seconds(seconds)
        return rows.withColumn(name, stamp).withWatermark(name, delay)

    names = code_names(dictionary, "source_type", "dic_name")
    details = lookup(trade.order_details(changes), names, ["source_type"], [], "inner")
    lines = timed(details, "ts", "line_time").drop("ts")
    headers = timed(trade.order_headers(changes), "header_ts", "header_time")
    headers = headers.withColumnRenamed("order_id", "header_id")
    extras = [
        (trade.order_activities(changes), "activity_ts", "activity_time", "activity_line"),
        (trade.order_coupons(changes), "coupon_ts", "coupon_time", "coupon_line"),
    ]
    for rows, seconds, name, key in extras:
        side = timed(rows, seconds, name).withColumnRenamed("order_detail_id", key)
        same = (F.col("order_detail_id") == F.col(key)) & _near("line_time", name, keep)
        lines = lines.join(side, same, "left").drop(key, name, seconds)
    same = (F.col("order_id") == F.col("header_id")) & _near("line_time", "header_time", keep)
    joined = lines.join(headers, same, "inner").withColumnRenamed("header_ts", "ts")
    return joined.select(*trade.WIDE_COLUMNS)


def newest_after_quiet_stream(
    records: DataFrame, key: str, event_ts: str, version: list[str], quiet: str = "2 seconds",
    delay: str = DELAY,
) -> DataFrame:
    """Newest version of a key, sent on once no further version came for ``quiet``."""
    rest = F.struct(*[c for c in records.columns if c not in (key, event_ts)])
    order = F.struct(*version)
    return (
        records.withWatermark(event_ts, delay)
        .groupBy(key, F.session_window(event_ts, quiet).alias("w"))
        .agg(F.max_by(rest, order).alias("r"))
        .select(key, "r.*")
    )


def spu_order_window_stream(enriched: DataFrame, delay: str = DELAY) -> DataFrame:
    """Orders and amounts per window and product family; two chained aggregations."""
    return metrics.spu_order_window(enriched.withWatermark("event_ts", delay))
