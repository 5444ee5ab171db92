"""Every operator as a query over the test tables: name -> function(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse import schemas as S
from tidehouse.functions import times, values
from tidehouse.operators import records, routing
from tidehouse.operators.changes import changes_of
from tidehouse.operators.intervals import interval_join
from tidehouse.operators.keyed import newest_per_key
from tidehouse.operators.lookup import is_small, regular_join, spread_join
from tidehouse.operators.visits import fix_is_new
from tidehouse.plans import actions, dimensions, metrics, trade, traffic
from tidehouse.sources import samples, topics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TIE = ["event_id"]
# Change-log tables that several queries read.
ORDER_LOG = ("order_info", "payment_info", "comment_info")
WIDE_LOG = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


def query(function: Query) -> Query:
    """Registers ``function`` under its name and pins the session time zone to UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    name = function.__name__.removesuffix("_query")
    run.__name__, run.__doc__ = name, function.__doc__
    QUERIES[name] = run
    return run


# --- sources -----------------------------------------------------------------------------------


@query
def src_topic_lines(spark, sf_dir):
    """Topic payloads as text; null payloads become empty."""
    events = samples.table(spark, sf_dir, "events")
    payload = F.when(F.col("event_type") != "error", F.col("props"))
    return topics.lines(events.select("event_id", payload.alias("value")))


@query
def src_topic_json(spark, sf_dir):
    """Typed records of a JSON topic."""
    orders = samples.table(spark, sf_dir, "orders")
    line = F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    return records.clean_records(topics.lines(orders.select(line.alias("value"))), schema)


@query
def src_cdc_envelope(spark, sf_dir):
    """Change records read back from their JSON lines."""
    log = samples.change_log(spark, sf_dir, "order_info", "payment_info")
    line = log.select(F.to_json(F.struct(*S.CHANGE.names)).alias("value"))
    parsed = topics.change_records(topics.lines(line))
    data, old = F.col("data"), F.col("old")
    return parsed.select(
        "database", "table", "type", "ts",
        F.coalesce(data["id"], data["order_id"]).alias("id"),
        data["order_status"].alias("order_status"),
        data["total_amount"].alias("total_amount"),
        data["payment_status"].alias("payment_status"),
        F.coalesce(old["order_status"], old["payment_status"]).alias("old_status"),
        F.col("pt").isNotNull().alias("has_pt"),
    )


@query
def src_config_latest(spark, sf_dir):
    """Newest configuration row per source table, from JSON change lines."""
    log = samples.config_changes(spark, sf_dir)
    line = log.select(F.to_json(F.struct(*S.CONFIG_CHANGE.names)).alias("value"))
    return routing.latest_config(topics.config_records(line))


@query
def src_dictionary(spark, sf_dir):
    """Dictionary rows."""
    return samples.dictionary(spark, sf_dir).select(
        "dic_code", "dic_name", "parent_code",
        times.second_text(F.col("create_time")).alias("create_time"),
        times.second_text(F.col("operate_time")).alias("operate_time"),
    )


@query
def src_csv_lines(spark, sf_dir):
    """Typed columns of comma-separated lines; unreadable numbers become null."""
    orders = samples.table(spark, sf_dir, "orders")
    seconds = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        F.unix_seconds("o_orderdate").cast("string")
    )
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority", seconds)
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("ts", T.LongType()),
        ]
    )
    return topics.comma_lines(orders.select(line.alias("value")), schema)


# --- projection and filters on the change log --------------------------------------------------


@query
def cdc_project(spark, sf_dir):
    """Order lines flattened from the change map."""
    return trade.order_details(samples.change_log(spark, sf_dir, "order_detail"))


@query
def cdc_route_insert(spark, sf_dir):
    """Inserts of one table out of the whole change log."""
    log = samples.change_log(spark, sf_dir, *ORDER_LOG)
    inserts = changes_of(log, "comment_info", [S.CHANGE_INSERT])
    return inserts.select("table", "type", "ts", *values.fields(F.col("data"), S.COMMENT_COLUMNS))


@query
def cdc_route_upsert(spark, sf_dir):
    """Inserts and updates of the order header."""
    headers = trade.order_headers(samples.change_log(spark, sf_dir, *ORDER_LOG))
    return headers.select(
        "order_id", "consignee", "total_amount", "order_status", "user_id", "payment_way",
        "operate_time", "province_id", "type", "header_ts",
        F.col("old")["order_status"].alias("old_order_status"),
    )


@query
def cart_add_delta(spark, sf_dir):
    """Added cart quantities."""
    return trade.cart_additions(samples.change_log(spark, sf_dir, "cart_info"))


@query
def changed_key_filter(spark, sf_dir):
    """Coupon updates whose raw previous values mention the using or the used time."""
    log = changes_of(
        samples.change_log(spark, sf_dir, "coupon_use"), "coupon_use", [S.CHANGE_UPDATE]
    ).withColumn("old_json", F.to_json("old", {"ignoreNullFields": "false"}))
    data, old = F.col("data"), F.col("old_json")
    flagged = log.select(
        data["id"].alias("id"), "ts",
        values.changed(old, "using_time").alias("using"),
        values.changed(old, "used_time").alias("used"),
    )
    return flagged.filter("using or used")


@query
def favor_add(spark, sf_dir):
    """Favourites added or added again."""
    return actions.favor_add(samples.change_log(spark, sf_dir, "favor_info"))


@query
def coupon_get(spark, sf_dir):
    return actions.coupon_get(samples.change_log(spark, sf_dir, "coupon_use"))


@query
def coupon_order(spark, sf_dir):
    return actions.coupon_order(samples.change_log(spark, sf_dir, "coupon_use"))


@query
def coupon_pay(spark, sf_dir):
    return actions.coupon_pay(samples.change_log(spark, sf_dir, "coupon_use"))


@query
def user_register(spark, sf_dir):
    return actions.registrations(samples.change_log(spark, sf_dir, "user_info"))


@query
def payment_success(spark, sf_dir):
    return trade.payments_done(samples.change_log(spark, sf_dir, "payment_info"))


@query
def refund_success(spark, sf_dir):
    return trade.refund_payments_done(samples.change_log(spark, sf_dir, "refund_payment"))


@query
def tombstone_filter(spark, sf_dir):
    """Inserts of a keyed topic; deletions arrive as empty payloads."""
    orders = samples.table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "insert").otherwise("update")
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("order_detail_id"), kind.alias("type")
    )
    line = F.when(F.col("o_orderstatus") != "P", F.to_json(record))
    schema = T.StructType(
        [T.StructField("order_detail_id", T.StringType()), T.StructField("type", T.StringType())]
    )
    parsed = records.clean_records(topics.lines(orders.select(line.alias("value"))), schema)
    return parsed.filter(F.col("type") == S.CHANGE_INSERT)


# --- application log ---------------------------------------------------------------------------


def _app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.clean_records(samples.app_log_lines(spark, sf_dir), S.APP_LOG)


@query
def dirty_split(spark, sf_dir):
    """Good and malformed lines of a mixed topic."""
    props = samples.table(spark, sf_dir, "events").select(
        F.lit("e").alias("origin"), F.col("event_id").alias("id"), F.col("props").alias("value")
    )
    texts = samples.table(spark, sf_dir, "documents").select(
        F.lit("d").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("value")
    )
    schema = T.StructType([T.StructField("k", T.LongType())])
    parsed = records.with_parsed(records.not_empty(props.unionByName(texts)), schema)
    return parsed.select(
        "origin", "id", "is_dirty", F.col("record.k").alias("k"),
        F.md5("value").alias("line_md5"),
    )


COMMON_COLUMNS = [f"common.{name}" for name in S.COMMON.names]


@query
def log_split_page(spark, sf_dir):
    pages = records.page_records(_app_log(spark, sf_dir))
    return pages.select(*COMMON_COLUMNS, "page.*", "err", "ts")


@query
def log_split_start(spark, sf_dir):
    starts = records.start_records(_app_log(spark, sf_dir))
    return starts.select(*COMMON_COLUMNS, "start", F.size("displays").alias("displays"), "ts")


@query
def log_split_error(spark, sf_dir):
    errors = records.error_records(_app_log(spark, sf_dir))
    return errors.select(
        *COMMON_COLUMNS, "page.page_id", "err", F.size("actions").alias("actions"), "ts"
    )


@query
def log_explode_display(spark, sf_dir):
    shown = records.display_records(_app_log(spark, sf_dir))
    return shown.select(
        "display_type", "item", "item_type", "pos_id", "order", "page_id", *COMMON_COLUMNS, "ts"
    )


@query
def log_explode_action(spark, sf_dir):
    done = records.action_records(_app_log(spark, sf_dir))
    return done.select("action_id", "item", "item_type", "page_id", *COMMON_COLUMNS, "ts")


@query
def fix_is_new_query(spark, sf_dir):
    """Corrected new-visitor flag of every page view."""
    pages = samples.page_log(spark, sf_dir)
    return fix_is_new(pages, "ts", TIE).select(
        "event_id", "mid", "page_id", "is_new", F.unix_millis("ts").alias("ts")
    )


@query
def unique_visitor(spark, sf_dir):
    """First session entry per visitor and day."""
    found = traffic.unique_visitors(samples.page_log(spark, sf_dir), TIE)
    return found.select("event_id", "mid", "page_id", F.unix_millis("ts").alias("ts"))


@query
def user_jump(spark, sf_dir):
    """Bounced session entries."""
    found = traffic.user_jumps(samples.page_log(spark, sf_dir, fast=True), TIE)
    return found.select("event_id", "mid", "page_id", F.unix_micros("ts").alias("ts_us"))


# --- joins ---------------------------------------------------------------------------------------


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = samples.change_log(spark, sf_dir, *WIDE_LOG)
    return trade.order_detail_wide(log, samples.dictionary(spark, sf_dir), laid=True)


def _flat_old(wide: DataFrame) -> DataFrame:
    """The wide record with its previous-values map reduced to the status."""
    return wide.withColumn("old_order_status", F.col("old")["order_status"]).drop("old")


@query
def order_detail_inner(spark, sf_dir):
    """Order lines with every change of their header."""
    log = samples.change_log(spark, sf_dir, "order_info", "order_detail")
    details = newest_per_key(trade.order_details(log), ["order_detail_id"], trade.DETAIL_VERSION)
    headers = trade.order_headers(log).select(
        "order_id", "order_status", "user_id", "type", "header_ts"
    )
    return spread_join(
        details, headers, ["order_id"], ["order_detail_id"], "inner", trade.hot_orders(log)
    ).select(
        "order_detail_id", "order_id", "sku_id", "split_original_amount", "order_status",
        "user_id", "type", "header_ts",
    )


@query
def order_detail_wide(spark, sf_dir):
    return _flat_old(_wide(spark, sf_dir))


@query
def order_add(spark, sf_dir):
    return _flat_old(trade.order_add(_wide(spark, sf_dir)))


@query
def order_cancel(spark, sf_dir):
    return _flat_old(trade.order_cancel(_wide(spark, sf_dir)))


@query
def pay_detail_wide(spark, sf_dir):
    log = samples.change_log(spark, sf_dir, *WIDE_LOG, "payment_info")
    return trade.pay_detail_of(log, samples.dictionary(spark, sf_dir), laid=True)


@query
def order_refund_wide(spark, sf_dir):
    log = samples.change_log(spark, sf_dir, "order_info", "order_refund_info")
    return trade.order_refund_wide(log, samples.dictionary(spark, sf_dir))


@query
def refund_pay_wide(spark, sf_dir):
    log = samples.change_log(spark, sf_dir, "order_info", "order_refund_info", "refund_payment")
    return trade.refund_pay_wide(log, samples.dictionary(spark, sf_dir))


@query
def lookup_inner(spark, sf_dir):
    """Cart additions with the name of their source."""
    log = samples.change_log(spark, sf_dir, "cart_info")
    return trade.cart_add(log, samples.dictionary(spark, sf_dir))


@query
def lookup_left(spark, sf_dir):
    """Comments with the name of their appraisal, also where unknown."""
    log = samples.change_log(spark, sf_dir, "comment_info")
    return actions.comments(log, samples.dictionary(spark, sf_dir))


@query
def interval_join_query(spark, sf_dir):
    """Clicks and views of one visitor at most five seconds apart."""
    pages = samples.page_log(spark, sf_dir, fast=True)

    def side(page: str, prefix: str) -> DataFrame:
        return pages.filter(F.col("page_id") == page).select(
            "mid", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts")
        )

    joined = interval_join(
        side(S.PAGE_HOME, "left"), side(S.PAGE_DETAIL, "right"), ["mid"], "left_ts", "right_ts",
        -5, 5,
    )
    gap = F.unix_micros("right_ts") - F.unix_micros("left_ts")
    return joined.select("mid", "left_id", "right_id", gap.alias("gap_us"))


def _two_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All customers with a name and all orders with a flag; many customers have several orders, some none."""
    customers, orders = samples.table(spark, sf_dir, "customer"), samples.table(spark, sf_dir, "orders")
    left = customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    right = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("sex"))
    return left, right


def _joined(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    left, right = _two_sides(spark, sf_dir)
    return regular_join(left, right, ["id"], ["name"], how).select("id", "name", "sex")


@query
def join_inner(spark, sf_dir):
    return _joined(spark, sf_dir, "inner")


@query
def join_left(spark, sf_dir):
    return _joined(spark, sf_dir, "left")


def _settled_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Settled orders with a name, and one flag per order that shipped a finished line; either side has ids the other one lacks."""
    orders = samples.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    lines = samples.table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    left = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"))
    right = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_returnflag").alias("sex"))
    return left, right


@query
def join_right(spark, sf_dir):
    """Flags without a settled order have no name."""
    left, right = _settled_sides(spark, sf_dir)
    return regular_join(left, right, ["id"], ["name"], "right").select("id", "name", "sex")


@query
def join_full(spark, sf_dir):
    """Both ids are kept: each is null where the other side has no partner."""
    left, right = _settled_sides(spark, sf_dir)
    left, right = left.withColumn("left_id", F.col("id")), right.withColumn("right_id", F.col("id"))
    return regular_join(left, right, ["id"], ["name"], "full").drop("id")


def _customers_and_orders(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    """Both tables whole and ungrouped: customers have many orders, some have none."""
    customers = samples.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), "c_custkey", F.col("c_name").alias("name")
    )
    orders = samples.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", F.col("o_orderstatus").alias("status")
    )
    return regular_join(customers, orders, ["id"], ["name"], how).drop("id")


@query
def fact_join_left(spark, sf_dir):
    return _customers_and_orders(spark, sf_dir, "left")


@query
def fact_join_full(spark, sf_dir):
    return _customers_and_orders(spark, sf_dir, "full")


@query
def newest_by_arrival(spark, sf_dir):
    """Of a customer's orders, all of one second, the one that arrived last."""
    orders = samples.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("order_id"), F.lit(0).alias("ts"), F.lit("same").alias("kind"),
        F.col("o_orderkey").alias("last"), F.struct(F.col("o_orderkey").alias("pos")).alias("seq"),
    )
    return newest_per_key(orders, ["order_id"], ["ts", "kind"]).select("order_id", "last")


# --- dimension tables --------------------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = samples.change_log(spark, sf_dir, "part", "supplier", "nation")
    return routing.routed(log, samples.dim_config(spark))


@query
def dim_route(spark, sf_dir):
    """Records of configured tables with their target; deletes and others are gone."""
    return _routed(spark, sf_dir).select("sink_table", "pk", "table", "type", "ts")


@query
def dim_prune_columns(spark, sf_dir):
    """Only the configured columns remain."""
    return _routed(spark, sf_dir).select(
        "sink_table", "pk", "type", F.to_json("data").alias("data")
    )


@query
def dim_upsert_latest(spark, sf_dir):
    """Current rows of all dimension tables."""
    return routing.newest_dimension_rows(_routed(spark, sf_dir)).select(
        "sink_table", "pk", F.to_json("data").alias("data")
    )


@query
def dim_schema_from_config(spark, sf_dir):
    """One dimension table with the columns its configuration names."""
    schema = routing.configured_schema(samples.dim_config(spark), "dim_part")
    rows = routing.newest_dimension_rows(_routed(spark, sf_dir))
    return routing.dimension_table(rows, "dim_part", schema)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placed order lines without the offer columns, which the product queries do not need."""
    log = samples.change_log(spark, sf_dir, "order_info", "order_detail")
    names = samples.dictionary(spark, sf_dir)
    return trade.order_add(trade.order_detail_wide(log, names, offers=False))


@query
def dim_chain_enrich(spark, sf_dir):
    """Order lines with product family, trademark and category names."""
    dims = samples.product_tables(spark, sf_dir)
    lines = _order_lines(spark, sf_dir).select("order_detail_id", "order_id", "user_id", "sku_id")
    return dimensions.with_product(
        lines, dimensions.flat_products(**dims), ["order_detail_id"], is_small(dims["sku"])
    )


# --- windows -----------------------------------------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    """Newest version of every order line."""
    log = samples.change_log(spark, sf_dir, "order_detail")
    return newest_per_key(trade.order_details(log), ["order_detail_id"], trade.DETAIL_VERSION)


def _traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = samples.page_log(spark, sf_dir, fast=True)
    return metrics.traffic_union(
        pages, traffic.unique_visitors(pages, TIE), traffic.user_jumps(pages, TIE)
    )


@query
def traffic_union(spark, sf_dir):
    """Page, visitor and bounce rows in one shape."""
    return _traffic(spark, sf_dir).withColumn("ts", F.unix_micros("ts"))


@query
def page_view_window(spark, sf_dir):
    """Traffic counters per ten seconds, version, channel, area and visitor kind."""
    return metrics.page_view_window(_traffic(spark, sf_dir))


@query
def keyword_explode(spark, sf_dir):
    """One row per searched word."""
    found = metrics.keyword_words(metrics.search_keywords(samples.page_log(spark, sf_dir)))
    return found.select("word", F.unix_millis("ts").alias("ts"))


@query
def keyword_sql_function(spark, sf_dir):
    """The same words through the SQL table function."""
    values.register_split_words(spark)
    keywords = metrics.search_keywords(samples.page_log(spark, sf_dir))
    return spark.sql(
        "SELECT word, unix_millis(ts) AS ts FROM {k}, LATERAL split_words(key_word)", k=keywords
    )


@query
def keyword_window(spark, sf_dir):
    """Searches per ten seconds and word."""
    pages = metrics.whole_second_pages(samples.page_log(spark, sf_dir, fast=True))
    return metrics.keyword_window(metrics.keyword_words(metrics.search_keywords(pages)))


@query
def home_detail_uv(spark, sf_dir):
    """Daily first visits of the home and the detail page per ten seconds."""
    pages = samples.page_log(spark, sf_dir)
    return metrics.home_detail_window(metrics.home_detail_first_visits(pages, TIE))


@query
def user_login(spark, sf_dir):
    """Daily logins and returns after eight days per ten seconds."""
    return metrics.user_login_window(metrics.user_logins(samples.page_log(spark, sf_dir), TIE))


@query
def cart_uu_window(spark, sf_dir):
    """Users who added to their cart for the first time that day, per ten seconds."""
    log = samples.change_log(spark, sf_dir, "cart_info")
    facts = trade.cart_add(log, samples.dictionary(spark, sf_dir))
    return metrics.cart_user_window(metrics.cart_first_of_day(facts, ["id"]))


@query
def user_register_window(spark, sf_dir):
    """Registrations per ten seconds."""
    log = samples.change_log(spark, sf_dir, "user_info")
    return metrics.register_window(actions.registrations(log))


@query
def trade_spu_window(spark, sf_dir):
    """Orders and amounts per ten seconds, user and product family."""
    dims = samples.product_tables(spark, sf_dir)
    lines = metrics.order_lines_for_window(_order_lines(spark, sf_dir))
    counted = metrics.spu_order_window(dimensions.with_product(lines, dims["sku"], ["order_id"]))
    return spu_names(counted, dims)


def spu_names(counted: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Window rows with the product names of their ids."""
    levels = dimensions.category_levels(*[dims[f"category{i}"] for i in (3, 2, 1)])
    return dimensions.with_product_names(
        counted, dims["spu"], dims["trademark"], levels, ["stt", "user_id"]
    ).select(*metrics.SPU_COLUMNS)


# --- functions -----------------------------------------------------------------------------------


@query
def fn_map_get(spark, sf_dir):
    """Map access with present, null and absent keys."""
    log = changes_of(samples.change_log(spark, sf_dir, "cart_info"), "cart_info")
    data, old = F.col("data"), F.col("old")
    return log.select(
        values.field(data, "id").alias("id"),
        "ts",
        values.field(data, "operate_time").alias("operate_time"),
        values.field(data, "no_such_key").alias("absent"),
        values.field(old, "sku_num").alias("old_sku_num"),
    )


@query
def fn_decimal_amount(spark, sf_dir):
    """Decimal casts and products of texts; unreadable numbers become null."""
    lines = samples.table(spark, sf_dir, "lineitem")
    quantity = F.when(F.col("l_returnflag") == "A", F.lit("many")).otherwise(
        F.col("l_quantity").cast("int").cast("string")
    )
    price = F.col("l_extendedprice").cast(values.MONEY).cast("string")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        values.amount(quantity, price).alias("amount"),
        values.as_int(quantity).alias("quantity"),
    )


@query
def fn_date_id(spark, sf_dir):
    """Day of a date-time text; null for other texts."""
    orders = samples.table(spark, sf_dir, "orders")
    when = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(
        times.second_text(F.col("o_orderdate"))
    )
    return orders.select("o_orderkey", times.date_id(when).alias("date_id"))


@query
def fn_epoch_to_ts(spark, sf_dir):
    """Epoch milliseconds to a timestamp of whole seconds."""
    events = samples.table(spark, sf_dir, "events")
    ts = times.from_epoch_ms_whole_seconds(F.unix_millis("ts"))
    return events.select("event_id", F.unix_micros(ts).alias("ts_us"))


@query
def fn_to_epoch_ms(spark, sf_dir):
    """Date-time and date texts to epoch milliseconds."""
    events = samples.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        times.epoch_ms(times.second_text(F.col("ts"))).alias("full_ms"),
        times.epoch_ms(times.day_of(F.col("ts")), full=False).alias("day_ms"),
    )


@query
def fn_epoch_format(spark, sf_dir):
    """Epoch milliseconds to day and second texts."""
    events = samples.table(spark, sf_dir, "events")
    ms = F.unix_millis("ts")
    return events.select(
        "event_id", times.epoch_day(ms).alias("day"), times.epoch_second_text(ms).alias("second")
    )


@query
def fn_ts_compare(spark, sf_dir):
    """Comparison of texts with one to three fraction digits."""
    events = samples.table(spark, sf_dir, "events")
    second = times.second_text(F.col("ts"))
    digits = (F.unix_millis("ts") % 1000).cast("string")
    left = F.concat(second, F.lit("."), F.lpad(digits, 3, "0"), F.lit("Z"))
    right = F.concat(second, F.lit("."), (F.col("user_id") % 100).cast("string"), F.lit("Z"))
    return events.select("event_id", times.compare_fractional(left, right).alias("cmp"))


@query
def fn_split(spark, sf_dir):
    """First token of a text and fields of a list."""
    events = samples.table(spark, sf_dir, "events")
    listed = F.concat_ws(",", "event_type", F.col("user_id").cast("string"), F.lit("x"))
    return events.select(
        "event_id",
        values.first_token(times.second_text(F.col("ts"))).alias("day"),
        F.try_element_at(F.split(listed, ","), F.lit(2)).alias("second_field"),
        F.size(F.split(listed, ",")).alias("fields"),
    )


@query
def fn_json(spark, sf_dir):
    """JSON path, key list, parsing and writing."""
    events = samples.table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k long")
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("path_k"),
        F.array_join(values.json_keys(F.col("props")), ",").alias("keys"),
        parsed["k"].alias("k"),
        F.to_json(F.struct((parsed["k"] + 1).alias("next"))).alias("written"),
    )


@query
def fn_proc_time(spark, sf_dir):
    """Processing-time columns: present and one value for all rows."""
    orders = samples.table(spark, sf_dir, "orders").select(
        "o_orderkey", *times.proc_time_columns()
    )
    gap = F.abs(F.unix_seconds("row_op_ts") - F.col("unix_s"))
    return orders.select(
        "o_orderkey", (gap <= 1).alias("same_second"),
        (F.unix_millis("row_op_ts") == F.col("now_ms")).alias("same_milli"),
    )
