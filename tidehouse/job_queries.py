"""The warehouse's jobs and the state behind them as queries: change logs with retractions, hops, late rows, deadlines.

Where the order of arrival matters, a table is dealt into deliveries by its own columns and every delivery is one micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.operators import patterns, routing
from tidehouse.operators.windows import tumble
from tidehouse.queries import WIDE_LOG, _flat_old, query, spu_names
from tidehouse.sources import samples
from tidehouse.stream_queries import Run, Warehouse, change_stream, pages_stream, table_stream
from tidehouse.streaming import deadlines, hops, incremental, joins, sinks, tables, warehouse


def deliver(run: Run, name: str, parts: Sequence[DataFrame], writer: sinks.BatchWriter) -> None:
    """Each part is delivered to one stream and taken in before the next one comes."""
    for part in parts:
        part.write.mode("append").parquet(run.path(f"{name}-deliveries"))
        run.each(run.spark.readStream.schema(part.schema).parquet(run.path(f"{name}-deliveries")), name, writer)


def _log_job(spark: SparkSession, sf_dir: str, table: str, *jobs: str) -> DataFrame:
    return Warehouse(spark, sf_dir, jobs[-1], changes=change_stream(spark, sf_dir, table)).run(*jobs)


# --- details of the change log ---------------------------------------------------------------------


@query
def job_cart_add(spark, sf_dir):
    """Cart additions as a job."""
    return _log_job(spark, sf_dir, "cart_info", "cart_add")


@query
def job_coupon_get(spark, sf_dir):
    return _log_job(spark, sf_dir, "coupon_use", "coupon_get")


@query
def job_coupon_order(spark, sf_dir):
    return _log_job(spark, sf_dir, "coupon_use", "coupon_order")


@query
def job_coupon_pay(spark, sf_dir):
    return _log_job(spark, sf_dir, "coupon_use", "coupon_pay")


@query
def job_favor_add(spark, sf_dir):
    return _log_job(spark, sf_dir, "favor_info", "favor_add")


@query
def job_comments(spark, sf_dir):
    return _log_job(spark, sf_dir, "comment_info", "comments")


@query
def job_registrations(spark, sf_dir):
    return _log_job(spark, sf_dir, "user_info", "registrations")


def _order_job(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    log = change_stream(spark, sf_dir, *WIDE_LOG)
    return _flat_old(Warehouse(spark, sf_dir, name, changes=log).run("order_detail", name))


@query
def job_order_add(spark, sf_dir):
    """Placed lines, from the change log of the order facts."""
    return _order_job(spark, sf_dir, "order_add")


@query
def job_order_cancel(spark, sf_dir):
    """Lines of cancelled orders, from the change log of the order facts."""
    return _order_job(spark, sf_dir, "order_cancel")


# --- the application log and windows -----------------------------------------------------------------


@query
def job_log_split(spark, sf_dir):
    """The five outputs of the application log, in one committed folder for each micro-batch."""
    split = Warehouse(spark, sf_dir, "log-split", app_log=samples.app_log(table_stream(spark, sf_dir, "events"))).run("log_split")
    return split.select(
        "topic", F.get_json_object("value", "$.common.mid").alias("mid"), F.get_json_object("value", "$.item").alias("item"),
        F.get_json_object("value", "$.ts").cast("long").alias("ts"),
    )


@query
def job_keyword_window(spark, sf_dir):
    """Searches per window and word, from added-up parts."""
    return Warehouse(spark, sf_dir, "keyword-window", pages=pages_stream(spark, sf_dir, fast=True)).run("keyword_window")


@query
def job_register_window(spark, sf_dir):
    return _log_job(spark, sf_dir, "user_info", "register_window")


@query
def job_user_login_window(spark, sf_dir):
    """Logins per window, behind the daily logins."""
    return Warehouse(spark, sf_dir, "user-login-window", pages=pages_stream(spark, sf_dir)).run("user_logins", "user_login_window")


@query
def stream_hop_once(spark, sf_dir):
    """First visits per window, where the hop before has run its batch again after its commit."""
    house = Warehouse(spark, sf_dir, "hop-once", pages=pages_stream(spark, sf_dir))
    first = house.run("home_detail_visits")
    again = hops.committing(spark, house.root, "home_detail_visits", warehouse.JOBS["home_detail_visits"].writer(house.path("home_detail_visits"), "", {}))
    again(first, 0)
    house.run("home_detail_window")
    again(first, 0)
    return house.run("home_detail_window")


# --- change logs and joins ---------------------------------------------------------------------------


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), "c_custkey", F.col("c_name").alias("name"), F.lit(0).cast("long").alias("left_s")
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("right_s")
    )


def _join_writer(run: Run, how: str) -> sinks.BatchWriter:
    return joins.regular_join_writer(run.path("log"), run.path("sides"), ["id"], how, joins.Side("left_s"), joins.Side("right_s"))


@query
def changelog_left_join(spark, sf_dir):
    """Customers come first and stand with nulls; a year's orders at a time take the nulls back and bring full rows."""
    run, customers, orders = Run(spark, "changelog-left"), _customers(spark, sf_dir), _orders(spark, sf_dir)
    year = F.year(F.timestamp_seconds("right_s"))
    low, high = orders.agg(F.min(year), F.max(year)).first()
    parts = [joins.two_sides(customers, orders.limit(0))]
    parts += [joins.two_sides(customers.limit(0), orders.filter(year == y)) for y in range(low, high + 1)]
    deliver(run, "log", parts, _join_writer(run, "left"))
    return run.read("log").select("kind", F.col("batch").cast("long").alias("batch"), "c_custkey", "name", "o_orderkey", "status")


def _regular(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    """Both tables dealt into six deliveries by a hash of their rows."""
    run, customers, orders = Run(spark, f"regular-{how}"), _customers(spark, sf_dir), _orders(spark, sf_dir)
    part = lambda df, k: df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(6)) == k)
    deliver(run, "log", [joins.two_sides(part(customers, k), part(orders, k)) for k in range(6)], _join_writer(run, how))
    return joins.joined(spark, run.path("log")).select("c_custkey", "o_orderkey", "name", "status")


@query
def stream_regular_left(spark, sf_dir):
    """Left join of two streams whose rows come in any order."""
    return _regular(spark, sf_dir, "left")


@query
def stream_regular_full(spark, sf_dir):
    """Full join of two streams whose rows come in any order."""
    return _regular(spark, sf_dir, "full")


@query
def changelog_window(spark, sf_dir):
    """Trade windows behind order facts: headers and earlier lines, then the later ones, whose newer versions replace counted lines.

    A line's versions lie years apart here, so windows stay open for ten years.
    """
    house = Warehouse(spark, sf_dir, "changelog-window")
    lines = samples.table(spark, sf_dir, "lineitem")
    log = samples.order_detail(lines)
    middle = log.agg(F.percentile_approx("ts", 0.5)).first()[0]
    headers = samples.order_info(samples.table(spark, sf_dir, "orders"))
    for part in (headers.unionByName(log.filter(F.col("ts") < middle)), log.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(house.path("changes"))
        house.inputs["changes"] = spark.readStream.schema(part.schema).parquet(house.path("changes"))
        counted = house.run("order_detail", "trade_window", lateness_s=3650 * incremental.DAY_S)
    return spu_names(counted, samples.product_tables(spark, sf_dir))


# --- patterns, dimensions as of a time, tables with deletions ------------------------------------------


@query
def pattern_bounces(spark, sf_dir):
    """Bounces as a pattern: an entry that another entry follows, or nothing in time."""
    pages = samples.page_log(spark, sf_dir, fast=True)
    found = patterns.matched(pages, patterns.bounces(F.col("last_page_id").isNull()), "mid", "ts", ["event_id"])
    return found.select("event_id", "mid", "page_id", F.unix_micros("ts").alias("ts_us"))


@query
def pattern_search_view_pay(spark, sf_dir):
    """A search result, then a product, then a payment, one behind the other in 20 seconds; timeouts with the steps they have."""
    pages = samples.page_log(spark, sf_dir, fast=True)
    pattern = patterns.Pattern.begin("search", F.col("last_page_id") == S.PAGE_SEARCH, 20)
    pattern = pattern.next("view", F.col("page_id") == S.PAGE_DETAIL).next("pay", F.col("page_id") == "payment")
    found = patterns.matched(pages, pattern, "mid", "ts", ["event_id"], ["event_id"])
    steps = [F.col(f"{name}.event_id").alias(f"{name}_id") for name in ("search", "view", "pay")]
    return found.select("mid", "outcome", "reached", *steps)


@query
def dim_route_as_of(spark, sf_dir):
    """Customer records routed by the configuration of their nation at their time; every supplier is a version of it."""
    config = samples.config_changes(spark, sf_dir).withColumn("op", F.when(F.col("after.sink_pk").isNull(), "r").otherwise("u"))
    versions = routing.config_versions(config.withColumn("ts_ms", F.col("ts_ms") * 1000))
    key = F.col("c_custkey").cast("string")
    changes = samples.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("source_"), F.col("c_nationkey").cast("string")).alias("table"), F.lit("insert").alias("type"),
        (F.col("c_custkey") % 120).cast("long").alias("ts"), F.create_map(F.lit("id"), key, F.lit("name"), F.col("c_name")).alias("data"),
    )
    return routing.routed_as_of(changes, versions).select("sink_table", "pk", "table", "ts", F.to_json("data").alias("data"))


@query
def sink_upsert_deletions(spark, sf_dir):
    """Orders upserted and taken away by customer: the newest order of each customer, unless it is a finished one."""
    run = Run(spark, "sink-deletions")
    table = tables.KeyedTable(run.path("orders"), ["o_custkey"], ["second", "o_orderkey"], deleted="o_orderstatus = 'F'")
    orders = table_stream(spark, sf_dir, "orders")
    rows = orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.unix_seconds("o_orderdate").alias("second"))
    run.each(rows, "orders", table.writer())
    return table.read(spark).select("o_custkey", "o_orderkey", "o_orderstatus")


@query
def job_dimensions(spark, sf_dir):
    """Part and supplier changes in compacted dimension tables."""
    changes = change_stream(spark, sf_dir, "part", "supplier")
    rows = Warehouse(spark, sf_dir, "dimensions", changes=changes).run("dimensions")
    return rows.select("sink_table", "pk", F.to_json("data").alias("data"))


# --- late rows and deadlines -------------------------------------------------------------------------


@query
def late_rows_kept(spark, sf_dir):
    """The second half of the month comes first; what is then too late for its window is set apart, window by window."""
    run = Run(spark, "late-kept")
    events = samples.table(spark, sf_dir, "events").select("ts")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    rule = incremental.additive(lambda rows: tumble(rows, {"event_ct": F.count(F.lit(1))}), ["event_ct"])
    writer = incremental.window_writer(run.path("windows"), run.path("parts"), "ts", rule, lateness_s=2)
    deliver(run, "windows", [events.filter(~early), events.filter(early)], writer)
    return tumble(spark.read.parquet(incremental.late_folder(run.path("windows"))), {"event_ct": F.count(F.lit(1))})


@query
def stream_first_deadline(spark, sf_dir):
    """Six deliveries of five days; a visitor's newest page is sent once, with the first delivery that ends ten days after
    the one that brought the visitor. The clock is the end of a delivery."""
    run = Run(spark, "first-deadline")
    pages = samples.page_log(spark, sf_dir).select("mid", "event_id", "page_id", "ts")
    chunk = F.least(F.floor((F.dayofmonth("ts") - 1) / 5), F.lit(5))
    writer = deadlines.deadline_writer(
        run.path("sent"), run.path("state"), ["mid"], ["ts", "event_id"], wait_s=10 * incremental.DAY_S,
        clock=lambda batch: batch.agg(F.max("ts")).first()[0],
    )
    deliver(run, "sent", [pages.filter(chunk == k) for k in range(6)], writer)
    return run.read("sent").select("mid", "event_id", "page_id", F.col("batch").cast("long").alias("batch"))
