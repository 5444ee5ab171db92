"""The warehouse's streaming jobs by table name: which streams a job reads, what it selects, and how it writes.

``start`` runs one of them below a root folder: results in ``<root>/<table>``, its commits in ``<root>/<table>-commits``, what it keeps
in ``<root>/<table>-store``, its checkpoint in ``<root>/checkpoint-<table>``. A job may be stopped and started again at any time;
``follow`` gives its committed batches as the input of the next hop, each once, and ``latest`` reads its results as a table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidehouse.operators import records, routing
from tidehouse.plans import actions, dimensions, metrics, trade, traffic
from tidehouse.streaming import changelog, hops, incremental, jobs, sinks
from tidehouse.streaming import tables as dimension_tables
from tidehouse.streaming.incremental import WindowRule, additive

Tables = dict[str, Callable[[], DataFrame]]
Writer = Callable[[str, str, Tables], sinks.BatchWriter]


@dataclass(frozen=True)
class Job:
    """``sources``: names of input streams; ``select``: from them to the job's rows; ``rule``: of a window table, with ``ts``, the
    column of its rows' time; ``read``: how a job's own kind of table is read."""

    sources: tuple[str, ...]
    select: Callable[..., DataFrame]
    writer: Writer | None = None
    rule: Callable[[Tables], WindowRule] | None = None
    ts: str = "ts"
    read: Callable[[SparkSession, str], DataFrame] | None = None


def _first_of_day(keys: list[str], ts: str = "ts") -> Writer:
    return lambda out, store, tables: incremental.first_of_day_writer(out, keys, ts)


def _orders(compute: Callable[[DataFrame, DataFrame], DataFrame], ids: tuple[str, ...] = ()) -> Writer:
    def writer(out: str, store: str, tables: Tables) -> sinks.BatchWriter:
        return incremental.order_facts_writer(out, store, lambda log: compute(log, tables["dictionary"]()), ids)

    return writer


def _rows(compute: Callable[..., DataFrame] = lambda rows: rows, *lookups: str) -> Writer:
    """Rows that follow from those of the micro-batch and the lookup tables as they are at that moment."""

    def writer(out: str, store: str, tables: Tables) -> sinks.BatchWriter:
        def write(batch: DataFrame, batch_id: int) -> None:
            compute(batch, *(tables[name]() for name in lookups)).write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))

        return write

    return writer


def _carts(out: str, store: str, tables: Tables) -> sinks.BatchWriter:
    return sinks.refreshed_writer(
        tables["dictionary"], lambda batch, names: metrics.with_cart_time(trade.cart_add(batch, names)),
        jobs.cart_first_of_day_writer(out, ["id"]),
    )


def _registered(changes: DataFrame) -> DataFrame:
    return actions.registrations(changes).withColumn("event_ts", F.timestamp_seconds("ts"))


#: Outputs of the application log.
TOPICS = {
    "page": records.page_records, "start": records.start_records, "error": records.error_records, "display": records.display_records,
    "action": records.action_records,
}


def split_log(log: DataFrame) -> DataFrame:
    """(topic, value) of all five outputs of the application log, as JSON lines."""
    out = None
    for name, select in TOPICS.items():
        lines = sinks.as_lines(select(log)).select(F.lit(name).alias("topic"), "value")
        out = lines if out is None else out.unionByName(lines)
    return out


def topic(split: DataFrame, name: str) -> DataFrame:
    """The lines of one output, from the rows of the job ``log_split``."""
    return split.filter(F.col("topic") == name).select("value")


def with_product(tables: Tables, lines: DataFrame) -> DataFrame:
    """Order lines with their event time and product ids, of the products as they are now."""
    timed = metrics.order_lines_for_window(lines) if changelog.KIND not in lines.columns else _signed_lines(lines)
    return dimensions.with_product(timed, tables["sku"](), ["order_id"])


def _signed_lines(log: DataFrame) -> DataFrame:
    plus = metrics.order_lines_for_window(log.filter(changelog.sign() > 0)).withColumn(changelog.KIND, F.lit("+I"))
    return plus.unionByName(metrics.order_lines_for_window(log.filter(changelog.sign() < 0)).withColumn(changelog.KIND, F.lit("-D")))


def _spu_rule(tables: Tables) -> WindowRule:
    return WindowRule(
        ["stt", "edt", *metrics.PRODUCT_IDS], ["lines", "amount"],
        lambda rows: metrics.spu_order_parts(with_product(tables, rows), changelog.sign()),
        metrics.spu_order_of_parts, ["order_id", "sku_id"], signed=True,
    )


def _order_lines(log: DataFrame) -> DataFrame:
    """Changes of placed order lines, with their time."""
    own = trade.order_add(log).select("order_detail_id", "order_id", "sku_id", "user_id", "split_total_amount", "order_create_time", changelog.KIND)
    return own.withColumn("event_ts", F.try_to_timestamp("order_create_time", F.lit("yyyy-MM-dd HH:mm:ss"))).filter("event_ts IS NOT NULL")


def _sums(compute: Callable[[DataFrame], DataFrame], measures: list[str], dims: list[str] = []) -> Callable[[Tables], WindowRule]:  # noqa: B006
    return lambda tables: additive(compute, measures, dims)


def _keyword_rows(pages: DataFrame) -> DataFrame:
    return metrics.keyword_words(metrics.search_keywords(metrics.whole_second_pages(pages)))


CHANGES, SAME = ("changes",), lambda rows: rows
JOBS: dict[str, Job] = {
    # dimensions and the log
    "dimensions": Job(
        CHANGES, SAME, lambda out, store, keep: dimension_tables.dimensions_writer(out, keep["config"]),
        read=lambda spark, path: dimension_tables.dimensions(path).read(spark),
    ),
    "log_split": Job(("app_log",), split_log, _rows()),
    # details of the log
    "unique_visitors": Job(("pages",), traffic.entry_pages, _first_of_day(["mid"])),
    "user_jumps": Job(("pages",), SAME, lambda out, store, tables: jobs.user_jumps_writer(out, store)),
    "true_visitors": Job(("pages",), SAME, lambda out, store, tables: jobs.new_visitor_writer(out, store)),
    "home_detail_visits": Job(("pages",), jobs.home_and_detail, _first_of_day(["mid", "page_id"])),
    "user_logins": Job(("pages",), jobs.known_entries, lambda out, store, tables: jobs.user_logins_writer(out, store)),
    # details of the change log
    "cart_add": Job(CHANGES, SAME, _rows(trade.cart_add, "dictionary")),
    "first_carts": Job(CHANGES, SAME, _carts),
    "order_detail": Job(CHANGES, incremental.with_order, _orders(trade.order_detail_wide)),
    "order_add": Job(("order_detail",), trade.order_add, _rows()),
    "order_cancel": Job(("order_detail",), trade.order_cancel, _rows()),
    "pay_detail": Job(CHANGES, incremental.with_order, _orders(trade.pay_detail_of, ("order_detail_id",))),
    "order_refund": Job(CHANGES, incremental.with_order, _orders(trade.order_refund_wide, ("id",))),
    "refund_pay": Job(CHANGES, incremental.with_order, _orders(trade.refund_pay_wide, ("id",))),
    "coupon_get": Job(CHANGES, actions.coupon_get, _rows()),
    "coupon_order": Job(CHANGES, actions.coupon_order, _rows()),
    "coupon_pay": Job(CHANGES, actions.coupon_pay, _rows()),
    "favor_add": Job(CHANGES, actions.favor_add, _rows()),
    "comments": Job(CHANGES, SAME, _rows(actions.comments, "dictionary")),
    "registrations": Job(CHANGES, actions.registrations, _rows()),
    # windows
    "page_view_window": Job(
        ("pages", "unique_visitors", "user_jumps"), metrics.traffic_union,
        rule=_sums(metrics.page_view_window, metrics.TRAFFIC_MEASURES, metrics.TRAFFIC_DIMS),
    ),
    "keyword_window": Job(("pages",), _keyword_rows, rule=_sums(metrics.keyword_window, ["keyword_count"], ["source", "keyword"])),
    "home_detail_window": Job(("home_detail_visits",), SAME, rule=_sums(metrics.home_detail_window, ["home_uv_ct", "good_detail_uv_ct"])),
    "user_login_window": Job(("user_logins",), SAME, rule=_sums(metrics.user_login_window, ["back_ct", "uu_ct"])),
    "cart_window": Job(
        ("first_carts",), lambda rows: rows.filter("event_ts IS NOT NULL"), rule=_sums(metrics.cart_user_window, ["cart_add_uu_ct"]), ts="event_ts"
    ),
    "register_window": Job(CHANGES, _registered, rule=_sums(metrics.register_window, ["register_ct"]), ts="event_ts"),
    "trade_window": Job(("order_detail",), _order_lines, rule=_spu_rule, ts="event_ts"),
}


def start(
    name: str, inputs: dict[str, DataFrame], root: str, tables: Tables | None = None, now: bool = True, lateness_s: int = incremental.LATENESS_S
) -> StreamingQuery:
    """Starts a job; ``inputs`` holds its streams by name, those of other jobs from ``follow``, ``tables`` its lookup tables, read anew
    for each micro-batch. Windows stay open for ``lateness_s``."""
    job, at, tables = JOBS[name], root.rstrip("/"), tables or {}
    streams = [inputs[source] for source in job.sources]
    spark, out, store = streams[0].sparkSession, f"{at}/{name}", f"{at}/{name}-store"
    if job.read:
        write = job.writer(out, store, tables)
    elif job.rule:
        write = incremental.window_writer(out, store, job.ts, job.rule(tables), lateness_s)
    else:
        write = hops.committing(spark, at, name, job.writer(out, store, tables))
    if not any(map(hops.is_hop, streams)):
        return sinks.each_batch(job.select(*streams), write, f"{at}/checkpoint-{name}", now)

    def selected(*inputs_and_id) -> None:
        write(job.select(*inputs_and_id[:-1]), inputs_and_id[-1])

    split = hops.each_input(spark, at, job.sources, streams, selected)
    return sinks.each_batch(hops.merged(streams), split, f"{at}/checkpoint-{name}", now)


def follow(spark: SparkSession, name: str, root: str) -> DataFrame:
    """A job's committed batches as a stream for ``start``, once it has committed some."""
    return hops.follow(spark, root, name)


def latest(spark: SparkSession, name: str, root: str, tables: Tables | None = None) -> DataFrame:
    """A job's results as a table: windows as they are by now, change logs replayed (order facts from their compacted log), else all
    committed rows (all there are, where the job's writer was run without ``start`` and so without commits)."""
    job, path = JOBS[name], f"{root.rstrip('/')}/{name}"
    if job.read:
        return job.read(spark, path)
    if job.rule:
        return incremental.windows_now(spark, path, job.rule(tables or {}))
    sent = incremental.order_results(f"{path}-store").before(spark)
    if sent is not None:
        return changelog.standing(sent)
    rows = hops.table(spark, root, name) if hops.committed(spark, root, name) else spark.read.parquet(path)
    return changelog.standing(rows) if changelog.KIND in rows.columns else rows.drop("batch")
