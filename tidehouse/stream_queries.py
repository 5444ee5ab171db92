"""Streaming queries: each runs its streams over the test tables to the end and returns the result.

The streams read the tables' folders as file sources, keep checkpoints and results below the
shared folder of the cluster, and stop when all present files are processed. Windows that the
watermark has not closed by then are not in the result, as in a running job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidehouse import schemas as S
from tidehouse.operators import records
from tidehouse.plans import actions, metrics, trade, traffic
from tidehouse.queries import TIE, WIDE_LOG, _flat_old, query, spu_names
from tidehouse.session import ROCKSDB, run_dir, settings, state_partitions
from tidehouse.sources import samples, topics
from tidehouse.streaming import incremental, jobs, joins, sinks, warehouse


# The test tables' events come in order.
NO_DELAY = "0 seconds"


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream of its files, with session-zone timestamps."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # A file source takes folders or patterns; the pattern fits a single file and a folder.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")
    zoned = {c: F.col(c).cast("timestamp") for c, t in stream.dtypes if t == "timestamp_ntz"}
    return stream.withColumns(zoned) if zoned else stream


def pages_stream(spark: SparkSession, sf_dir: str, fast: bool = False) -> DataFrame:
    return samples.pages_of(table_stream(spark, sf_dir, "events"), fast)


class Run:
    """Folders of one run: results, checkpoints and the streams between them."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, run_dir(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def finish(self, start: Callable[[], StreamingQuery]) -> None:
        """Starts a stream and waits until all present input is processed; errors are raised."""
        needed = {
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.shuffle.partitions": state_partitions(self.spark),
        }
        with settings(self.spark, needed):
            start().awaitTermination()

    def write(self, df: DataFrame, name: str) -> None:
        check = self.path(f"checkpoint-{name}")
        self.finish(lambda: sinks.append_rows(df, self.path(name), check))

    def each(self, df: DataFrame, name: str, writer: sinks.BatchWriter) -> None:
        check = self.path(f"checkpoint-{name}")
        self.finish(lambda: sinks.each_batch(df, writer, check))

    def jumps(self, pages: DataFrame) -> None:
        self.each(
            pages, "jumps",
            jobs.user_jumps_writer(self.path("jumps"), self.path("pending"), TIE),
        )

    def visitors(self, pages: DataFrame) -> DataFrame:
        writer = jobs.unique_visitors_writer(self.path("visitors"), TIE)
        self.each(traffic.entry_pages(pages), "visitors", writer)
        return self.read("visitors").drop("batch")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str) -> DataFrame:
        return self.spark.readStream.schema(self.read(name).schema).parquet(self.path(name))

    def result(self, df: DataFrame) -> DataFrame:
        self.write(df, "result")
        return self.read("result")


# --- detail layer --------------------------------------------------------------------------------


def _fixed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    run = Run(spark, name)
    pages = pages_stream(spark, sf_dir).select("event_id", "mid", "page_id", "is_new", "ts")
    run.each(pages, "fixed", jobs.new_visitor_writer(run.path("fixed"), run.path("days"), TIE))
    return run.read("fixed").drop("batch").withColumn("ts", F.unix_millis("ts"))


@query
def stream_fix_is_new(spark, sf_dir):
    """Corrected new-visitor flags; the first micro-batch with a visitor decides."""
    return _fixed(spark, sf_dir, "fix-is-new")


@query
def stream_fix_is_new_table(spark, sf_dir):
    """Corrected new-visitor flags with the new days in a table."""
    return _fixed(spark, sf_dir, "fix-is-new-table")


@query
def stream_unique_visitor(spark, sf_dir):
    """Visitors of each day."""
    out = Run(spark, "unique-visitor").visitors(pages_stream(spark, sf_dir))
    return out.select("mid", F.date_format("ts", S.DAY_FORMAT).alias("day"))


@query
def stream_unique_visitor_first(spark, sf_dir):
    """The record that each day's visit is counted by: the first of the day."""
    out = Run(spark, "unique-visitor-first").visitors(pages_stream(spark, sf_dir))
    return out.select("mid", "event_id", F.date_format("ts", S.DAY_FORMAT).alias("day"))


@query
def stream_user_jump(spark, sf_dir):
    """Bounced session entries."""
    pages = pages_stream(spark, sf_dir, fast=True).select("event_id", "mid", "last_page_id", "ts")
    run = Run(spark, "user-jump")
    run.jumps(pages)
    return run.read("jumps").select("event_id", "mid", F.unix_micros("ts").alias("ts_us"))


@query
def stream_cart_first(spark, sf_dir):
    """Users who added to their cart, per day."""
    additions = trade.cart_additions(samples.cart_info(table_stream(spark, sf_dir, "lineitem")))
    run = Run(spark, "cart-first")
    timed = metrics.with_cart_time(additions)
    run.each(timed, "first", jobs.cart_first_of_day_writer(run.path("first"), ["id"]))
    return run.read("first").select("user_id", "cart_day")


# --- joins -----------------------------------------------------------------------------------------


def _click_and_view(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def side(page: str, prefix: str) -> DataFrame:
        pages = pages_stream(spark, sf_dir, fast=True).filter(F.col("page_id") == page)
        return pages.select(
            "mid", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts")
        )

    return side(S.PAGE_HOME, "left"), side(S.PAGE_DETAIL, "right")


@query
def stream_interval_join(spark, sf_dir):
    """Clicks and views of one visitor at most five seconds apart."""
    left, right = _click_and_view(spark, sf_dir)
    joined = jobs.interval_join_stream(left, right, "mid", "left_ts", "right_ts", delay=NO_DELAY)
    gap = F.unix_micros("right_ts") - F.unix_micros("left_ts")
    out = Run(spark, "interval-join").result(
        joined.select("mid", "left_id", "right_id", gap.alias("gap_us"))
    )
    return out


@query
def stream_left_join(spark, sf_dir):
    """Clicks with the views near them; lonely clicks follow when the watermark has passed."""
    left, right = _click_and_view(spark, sf_dir)
    joined = jobs.interval_join_stream(left, right, "mid", "left_ts", "right_ts", how="left", delay=NO_DELAY)
    return Run(spark, "left-join").result(joined.select("mid", "left_id", "right_id"))


def _near_join(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    left, right = _click_and_view(spark, sf_dir)
    run = Run(spark, f"{how}-join")
    run.each(joins.two_sides(left, right), "pairs", joins.interval_join_writer(run.path("pairs"), run.path("state"), ["mid"], "left_ts", "right_ts", how=how))
    return run.read("pairs").select("mid", "left_id", "right_id")


@query
def stream_full_join(spark, sf_dir):
    """Clicks and views near each other, and the lonely ones of both sides."""
    return _near_join(spark, sf_dir, "full")


@query
def stream_right_join(spark, sf_dir):
    """Views with the clicks near them; lonely views follow when the mark has passed."""
    return _near_join(spark, sf_dir, "right")


@query
def stream_lookup(spark, sf_dir):
    """Cart additions named by a dictionary that is read anew for every micro-batch."""
    run = Run(spark, "lookup")
    writer = sinks.refreshed_writer(
        lambda: samples.dictionary(spark, sf_dir),
        trade.cart_add,
        sinks.window_writer([*S.CART_COLUMNS, "dic_name", "ts"], run.path("facts")),
    )
    run.each(samples.cart_info(table_stream(spark, sf_dir, "lineitem")), "facts", writer)
    return run.read("facts").drop("batch")


# --- windows ---------------------------------------------------------------------------------------


@query
def stream_page_view_window(spark, sf_dir):
    """Traffic counters: visitor and bounce topics are written first, then all three are joined."""
    run = Run(spark, "page-view-window")
    run.visitors(pages_stream(spark, sf_dir, fast=True))
    run.jumps(pages_stream(spark, sf_dir, fast=True))
    return run.result(
        jobs.page_view_window_stream(
            pages_stream(spark, sf_dir, fast=True), run.stream("visitors"), run.stream("jumps")
        )
    )


@query
def stream_keyword_window(spark, sf_dir):
    """Searches per ten seconds and word."""
    pages = pages_stream(spark, sf_dir, fast=True)
    return Run(spark, "keyword-window").result(jobs.keyword_window_stream(pages))


@query
def stream_home_detail(spark, sf_dir):
    """Daily first visits of two pages per ten seconds."""
    run = Run(spark, "home-detail")
    pages = jobs.home_and_detail(pages_stream(spark, sf_dir))
    run.each(pages, "visits", jobs.home_detail_visits_writer(run.path("visits"), TIE))
    return run.result(jobs.home_detail_window_stream(run.stream("visits")))


@query
def stream_user_login(spark, sf_dir):
    """Daily logins and returns per ten seconds, with the last login kept per user."""
    run = Run(spark, "user-login")
    entries = jobs.known_entries(pages_stream(spark, sf_dir))
    run.each(entries, "logins", jobs.user_logins_writer(run.path("logins"), run.path("last"), TIE))
    return run.result(jobs.user_login_window_stream(run.stream("logins")))


@query
def stream_newest(spark, sf_dir):
    """Last page of a visitor before two quiet seconds."""
    pages = pages_stream(spark, sf_dir, fast=True)
    versions = pages.select("mid", "ts", F.unix_micros("ts").alias("us"), "event_id", "page_id")
    newest = jobs.newest_after_quiet_stream(versions, "mid", "ts", ["us", "event_id"])
    return Run(spark, "newest").result(newest)


# --- trade, from the change log to facts and windows ---------------------------------------------


def change_stream(spark: SparkSession, sf_dir: str, *only: str) -> DataFrame:
    """The change log of the named tables as one stream."""
    sources: dict[str, DataFrame] = {}
    logs = []
    for name in only:
        source, make = samples.CHANGE_TABLES[name]
        if source not in sources:
            sources[source] = table_stream(spark, sf_dir, source)
        logs.append(make(sources[source]))
    return reduce(DataFrame.unionByName, logs)


def _facts(spark: SparkSession, sf_dir: str, name: str, tables: Sequence[str], compute) -> DataFrame:
    """Facts of all orders, written by micro-batches as a change log and replayed."""
    run = Run(spark, name)
    names = samples.dictionary(spark, sf_dir)
    writer = incremental.order_facts_writer(run.path("facts"), run.path("changes"), lambda log: compute(log, names))
    run.each(incremental.with_order(change_stream(spark, sf_dir, *tables)), "facts", writer)
    return incremental.current(spark, run.path("facts"), ["order_id"])


@query
def stream_order_detail(spark, sf_dir):
    """Order lines with header, activity, coupon and source name."""
    return _flat_old(_facts(spark, sf_dir, "order-detail", WIDE_LOG, trade.order_detail_wide))


@query
def stream_order_add(spark, sf_dir):
    """Order lines as they were placed, selected from the streamed facts."""
    return _flat_old(trade.order_add(_facts(spark, sf_dir, "order-add", WIDE_LOG, trade.order_detail_wide)))


@query
def stream_order_cancel(spark, sf_dir):
    """Lines of cancelled orders, selected from the streamed facts."""
    return _flat_old(trade.order_cancel(_facts(spark, sf_dir, "order-cancel", WIDE_LOG, trade.order_detail_wide)))


@query
def stream_pay_detail(spark, sf_dir):
    """Paid order lines."""
    return _facts(spark, sf_dir, "pay-detail", (*WIDE_LOG, "payment_info"), trade.pay_detail_of)


@query
def stream_order_refund(spark, sf_dir):
    """Refund requests with province and code names."""
    return _facts(spark, sf_dir, "order-refund", ("order_info", "order_refund_info"), trade.order_refund_wide)


@query
def stream_refund_pay(spark, sf_dir):
    """Paid refunds with buyer, province and quantity."""
    tables = ("order_info", "order_refund_info", "refund_payment")
    return _facts(spark, sf_dir, "refund-pay", tables, trade.refund_pay_wide)


def lookups(spark: SparkSession, sf_dir: str) -> warehouse.Tables:
    """The lookup tables of the warehouse's jobs."""
    return {
        "dictionary": lambda: samples.dictionary(spark, sf_dir), "config": lambda: samples.dim_config(spark),
        "sku": lambda: samples.product_tables(spark, sf_dir)["sku"],
    }


class Warehouse(Run):
    """Jobs of the warehouse below one root, each fed by streams of the tables or by the job before it."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str, **inputs: DataFrame) -> None:
        super().__init__(spark, name)
        self.inputs, self.tables = inputs, lookups(spark, sf_dir)

    def run(self, *names: str, **options) -> DataFrame:
        """Runs the jobs in turn and gives the last one's table."""
        for name in names:
            self.finish(lambda: warehouse.start(name, self.inputs, self.root, self.tables, **options))
            if not (warehouse.JOBS[name].rule or warehouse.JOBS[name].read):
                self.inputs[name] = warehouse.follow(self.spark, name, self.root)
        return warehouse.latest(self.spark, names[-1], self.root, self.tables)


@query
def stream_trade_spu_window(spark, sf_dir):
    """Orders and amounts per window, user and product family, from the change log on.

    Order facts are the first hop, a change log; the second looks the product up anew in every
    micro-batch, adds what comes and subtracts what is taken back.
    """
    changes = change_stream(spark, sf_dir, *WIDE_LOG)
    counted = Warehouse(spark, sf_dir, "trade-spu-window", changes=changes).run("order_detail", "trade_window")
    return spu_names(counted, samples.product_tables(spark, sf_dir))


@query
def stream_cart_uu_window(spark, sf_dir):
    """Users who added to their cart for the first time that day, per ten seconds, from the log on."""
    changes = change_stream(spark, sf_dir, "cart_info")
    return Warehouse(spark, sf_dir, "cart-uu-window", changes=changes).run("first_carts", "cart_window")


# --- sinks -----------------------------------------------------------------------------------------


@query
def sink_append(spark, sf_dir):
    """Page views appended to a topic as JSON lines, and read back."""
    run = Run(spark, "sink-append")
    pages = pages_stream(spark, sf_dir).select("event_id", "mid", "page_id", "last_page_id")
    run.finish(lambda: sinks.append_topic(pages, run.path("topic"), run.path("checkpoint")))
    lines = topics.read_topic(spark, run.path("topic"), streaming=False)
    return records.clean_records(lines, pages.schema)


@query
def sink_upsert_latest(spark, sf_dir):
    """Order headers upserted by id; the table shows the newest change."""
    run = Run(spark, "sink-upsert")
    changes = samples.order_info(table_stream(spark, sf_dir, "orders"))
    headers = trade.order_headers(changes).drop("old")
    writer = sinks.upsert_writer(run.path("orders"), ["order_id"], ["header_ts"])
    run.each(headers, "orders", writer)
    latest = sinks.read_latest(spark, run.path("orders"), ["order_id"], ["header_ts"])
    return latest.select("order_id", "order_status", "user_id", "type", "header_ts")


@query
def sink_window_result(spark, sf_dir):
    """Registrations per window, written in the table's column order."""
    run = Run(spark, "sink-window")
    changes = samples.user_info(table_stream(spark, sf_dir, "events"))
    counted = jobs.register_window_stream(actions.registrations(changes))
    writer = sinks.window_writer(
        ["stt", "edt", "register_ct", "note"], run.path("registered"), transient=["note"]
    )
    run.each(counted.withColumn("note", F.lit("not stored")), "registered", writer)
    return run.read("registered").select("stt", "edt", "register_ct")


@query
def sink_dimensions(spark, sf_dir):
    """Part changes routed by configuration into the folder of their dimension table."""
    run = Run(spark, "sink-dimensions")
    changes = samples.part_changes(table_stream(spark, sf_dir, "part"))
    writer = sinks.dimension_writer(run.path("dims"), lambda: samples.dim_config(spark))
    run.each(changes, "dims", writer)
    return run.read("dims").select("sink_table", "pk", "type", F.to_json("data").alias("data"))


@query
def sink_fan_out(spark, sf_dir):
    """The application log split into its five topics."""
    run = Run(spark, "sink-fan-out")
    log = samples.app_log(table_stream(spark, sf_dir, "events"))
    lines = log.select(F.to_json(F.struct(*S.APP_LOG.names)).alias("value"))
    branches = {
        "page": records.page_records,
        "start": records.start_records,
        "error": records.error_records,
        "display": records.display_records,
        "action": records.action_records,
    }
    run.each(
        records.clean_records(lines, S.APP_LOG), "log", sinks.fan_out_writer(run.root, branches)
    )
    out = None
    for name in branches:
        line = topics.read_topic(spark, run.path(name), streaming=False)
        rows = line.select(
            F.lit(name).alias("topic"),
            F.get_json_object("value", "$.common.mid").alias("mid"),
            F.get_json_object("value", "$.item").alias("item"),
            F.get_json_object("value", "$.ts").cast("long").alias("ts"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


# --- late data and retention -------------------------------------------------------------------------


@query
def late_rows_dropped(spark, sf_dir):
    """The second half of the month arrives first; the first half is then too late to count."""
    run = Run(spark, "late-rows")
    events = samples.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (events.filter(~early), events.filter(early)):
        part.write.mode("append").parquet(run.path("deliveries"))
        stream = spark.readStream.schema(part.schema).parquet(run.path("deliveries"))
        counted = metrics.tumble(
            stream.withWatermark("ts", "2 seconds"), {"event_ct": F.count(F.lit(1))}
        )
        run.write(counted, "result")
    return run.read("result")
