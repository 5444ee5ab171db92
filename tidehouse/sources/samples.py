"""The shop's inputs derived from the test tables.

Every column is computed from its own row, so the derivation itself shuffles nothing; only the
dictionary and the small product dimensions are grouped. ``FIXTURES.md`` part B lists the rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.functions.times import second_text

MONEY = "decimal(16,2)"
FAST_START_US = 1704152400000000  # 2024-01-01 23:40:00 UTC
LOG_START_US = 1704067200000000  # 2024-01-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its zone-less timestamps become session-zone timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoned = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(zoned) if zoned else df


def text(value: Column) -> Column:
    return value.cast("string")


def record_map(entries: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), text(v))])


def change(
    df: DataFrame, name: str, kind: Column, ts: Column, data: dict[str, Column], old: Column
) -> DataFrame:
    return df.select(
        F.lit(S.DATABASE).alias("database"),
        F.lit(name).alias("table"),
        kind.alias("type"),
        ts.cast("long").alias("ts"),
        record_map(data).alias("data"),
        old.cast(S.STRING_MAP).alias("old"),
    )


def no_old() -> Column:
    return F.lit(None)


# --- application log -------------------------------------------------------------------------


def page_id_of() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "view", S.PAGE_DETAIL)
        .when(kind == "click", S.PAGE_HOME)
        .when(kind == "purchase", "payment")
        .when(kind == "signup", "register")
        .otherwise("error")
    )


def page_log(spark: SparkSession, sf_dir: str, fast: bool = False) -> DataFrame:
    return pages_of(table(spark, sf_dir, "events"), fast)


def pages_of(events: DataFrame, fast: bool = False) -> DataFrame:
    """Flat page views of the event table (also of a stream of it).

    ``fast`` runs the clock a thousand times faster and across a midnight, so that ten-second
    rules have something to decide.
    """
    user, number = F.col("user_id"), F.col("event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    clock = F.timestamp_micros(
        F.lit(FAST_START_US) + F.floor((us - F.lit(LOG_START_US)) / F.lit(1000)).cast("long")
    )
    previous = number % 3
    search = previous == 1
    return events.select(
        "event_id",
        (clock if fast else F.col("ts").cast("timestamp")).alias("ts"),
        text(user).alias("mid"),
        F.when(user % 5 != 0, text(user)).alias("uid"),
        F.concat(F.lit("v"), text(user % 3)).alias("vc"),
        F.concat(F.lit("c"), text(user % 2)).alias("ch"),
        F.concat(F.lit("r"), text(user % 4)).alias("ar"),
        F.when(number % 4 == 0, "0").otherwise("1").alias("is_new"),
        page_id_of().alias("page_id"),
        F.when(search, S.PAGE_SEARCH).when(previous == 2, S.PAGE_HOME).alias("last_page_id"),
        F.when(
            search,
            F.concat(F.lit("手机 "), "event_type", F.lit(" K"), F.get_json_object("props", "$.k")),
        ).alias("item"),
        F.when(search, S.ITEM_KEYWORD).alias("item_type"),
        F.round(F.col("value").cast(MONEY) * 100).cast("long").alias("during_time"),
    )


def app_log(events: DataFrame) -> DataFrame:
    """Nested application records of the event table.

    Sign-ups are start records, errors carry ``err``; each record has zero to three displays and
    actions.
    """
    p = pages_of(events.select("*"))
    number = F.col("event_id")
    some = F.when(number % 4 > 0, F.sequence(F.lit(1), (number % 4).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    ms = F.unix_millis("ts")
    displays = F.transform(
        some,
        lambda i: F.struct(
            F.lit("promotion").alias("display_type"),
            text(number + i).alias("item"),
            F.lit("sku_id").alias("item_type"),
            text(i).alias("pos_id"),
            text(i).alias("order"),
        ),
    )
    actions = F.transform(
        some,
        lambda i: F.struct(
            F.concat(F.lit("act"), text(i)).alias("action_id"),
            text(number * 2 + i).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (ms + i).alias("ts"),
        ),
    )
    return p.select(
        number,
        F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common"),
        F.struct("page_id", "last_page_id", "item", "item_type", "during_time").alias("page"),
        F.when(F.col("page_id") == "register", F.lit('{"entry":"icon"}')).alias("start"),
        F.when(F.col("page_id") == "error", F.lit('{"error_code":"1001"}')).alias("err"),
        displays.alias("displays"),
        actions.alias("actions"),
        ms.alias("ts"),
    )


def app_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application log as JSON lines."""
    log = app_log(table(spark, sf_dir, "events"))
    return log.select(F.to_json(F.struct(*S.APP_LOG.names)).alias("value"))


# --- change log ------------------------------------------------------------------------------


def order_info(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    placed = F.unix_seconds("o_orderdate")
    base = {
        "id": F.col("o_orderkey"),
        "consignee": F.concat(F.lit("buyer "), text(F.col("o_custkey"))),
        "total_amount": F.col("o_totalprice").cast(MONEY),
        "user_id": F.col("o_custkey"),
        "payment_way": F.left("o_orderpriority", F.lit(1)),
        "province_id": F.col("o_custkey") % 34,
        "original_total_amount": F.col("o_totalprice").cast(MONEY),
    }
    inserted = change(
        orders, "order_info", F.lit("insert"), placed, {**base, "order_status": F.lit("1001")},
        no_old(),
    )
    after = (
        F.when(status == "O", "1002").when(status == "F", S.ORDER_CANCELLED)
        .otherwise(S.ORDER_REFUNDING)
    )
    updated = change(
        orders, "order_info", F.lit("update"), placed + 86400,
        {**base, "order_status": after,
         "operate_time": second_text(F.timestamp_seconds(placed + 86400))},
        record_map({"order_status": F.lit("1001")}),
    )
    return inserted.unionByName(updated)


def line_id() -> Column:
    return F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber")))


def line_time() -> Column:
    """Ship day plus a second of the first minute."""
    return F.unix_seconds("l_shipdate") + F.col("l_partkey") % 60


def line_time_text() -> Column:
    return second_text(F.timestamp_seconds(line_time()))


def order_detail(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast(MONEY)
    return change(
        lineitem, "order_detail", F.lit("insert"), line_time(),
        {
            "id": line_id(),
            "order_id": F.col("l_orderkey"),
            "sku_id": F.col("l_partkey"),
            "sku_name": F.concat(F.lit("part "), text(F.col("l_partkey"))),
            "order_price": price,
            "sku_num": F.col("l_quantity").cast("int"),
            "create_time": line_time_text(),
            "source_type": F.col("l_linenumber") % 5,
            "source_id": F.col("l_suppkey"),
            "split_total_amount": price * (F.lit(1).cast("decimal(5,2)")
                                           - F.col("l_discount").cast("decimal(5,2)")),
            "split_activity_amount": F.when(F.col("l_returnflag") == "A", F.lit("10.00")),
            "split_coupon_amount": F.when(F.col("l_discount") > 0.05, F.lit("5.00")),
        },
        no_old(),
    )


def order_detail_activity(lineitem: DataFrame) -> DataFrame:
    return change(
        lineitem.filter("l_returnflag = 'A'"), "order_detail_activity", F.lit("insert"),
        line_time(),
        {
            "id": line_id(),
            "order_id": F.col("l_orderkey"),
            "order_detail_id": line_id(),
            "activity_id": F.col("l_suppkey"),
            "activity_rule_id": F.col("l_partkey"),
            "sku_id": F.col("l_partkey"),
            "create_time": line_time_text(),
        },
        no_old(),
    )


def order_detail_coupon(lineitem: DataFrame) -> DataFrame:
    return change(
        lineitem.filter(F.col("l_discount") > 0.05), "order_detail_coupon", F.lit("insert"),
        line_time(),
        {
            "id": line_id(),
            "order_id": F.col("l_orderkey"),
            "order_detail_id": line_id(),
            "coupon_id": F.col("l_suppkey"),
            "coupon_use_id": F.col("l_partkey"),
            "sku_id": F.col("l_partkey"),
            "create_time": line_time_text(),
        },
        no_old(),
    )


def cart_info(lineitem: DataFrame) -> DataFrame:
    """Not returned: insert; returned with open status: quantity change; else another change."""
    fresh = F.col("l_returnflag") == "N"
    old = F.when(~fresh & (F.col("l_linestatus") == "O"),
                 record_map({"sku_num": F.col("l_partkey") % 50})).when(
        ~fresh, record_map({"is_checked": F.lit("0")}))
    return change(
        lineitem, "cart_info", F.when(fresh, "insert").otherwise("update"), line_time(),
        {
            "id": line_id(),
            "user_id": F.col("l_suppkey"),
            "sku_id": F.col("l_partkey"),
            "cart_price": F.col("l_extendedprice").cast(MONEY),
            "sku_num": F.col("l_quantity").cast("int"),
            "sku_name": F.concat(F.lit("part "), text(F.col("l_partkey"))),
            "is_checked": F.lit("1"),
            "create_time": second_text(F.col("l_shipdate")),
            "operate_time": F.when(~fresh, line_time_text()),
            "is_ordered": F.lit("0"),
            "source_type": F.col("l_linenumber") % 5,
            "source_id": F.col("l_suppkey"),
        },
        old,
    )


def payment_info(orders: DataFrame) -> DataFrame:
    """Every order is paid by an update; pending ones stay unpaid, low ones keep their status."""
    kept = F.col("o_orderpriority") == "5-LOW"
    return change(
        orders, "payment_info", F.lit("update"), F.unix_seconds("o_orderdate"),
        {
            "user_id": F.col("o_custkey"),
            "order_id": F.col("o_orderkey"),
            "payment_type": F.left("o_orderpriority", F.lit(1)),
            "callback_time": second_text(F.col("o_orderdate")),
            "payment_status": F.when(F.col("o_orderstatus") == "P", "1601").otherwise(
                S.PAYMENT_DONE),
        },
        F.when(kept, record_map({"callback_time": F.lit("")})).otherwise(
            record_map({"payment_status": F.lit("1601")})),
    )


def order_refund_info(lineitem: DataFrame) -> DataFrame:
    return change(
        lineitem.filter("l_returnflag = 'R'"), "order_refund_info", F.lit("insert"), line_time(),
        {
            "id": line_id(),
            "user_id": F.col("l_suppkey"),
            "order_id": F.col("l_orderkey"),
            "sku_id": F.col("l_partkey"),
            "refund_type": F.col("l_linenumber"),
            "refund_num": F.col("l_quantity").cast("int"),
            "refund_amount": F.col("l_extendedprice").cast(MONEY),
            "refund_reason_type": F.col("l_linenumber") % 3,
            "refund_reason_txt": F.concat(F.lit("reason "), text(F.col("l_suppkey"))),
            "create_time": line_time_text(),
        },
        no_old(),
    )


def refund_payment(lineitem: DataFrame) -> DataFrame:
    return change(
        lineitem.filter("l_returnflag = 'R'"), "refund_payment", F.lit("update"), line_time(),
        {
            "id": line_id(),
            "order_id": F.col("l_orderkey"),
            "sku_id": F.col("l_partkey"),
            "payment_type": F.col("l_linenumber"),
            "callback_time": line_time_text(),
            "total_amount": F.col("l_extendedprice").cast(MONEY),
            "refund_status": F.when(F.col("l_linestatus") == "F", S.REFUND_DONE).otherwise("0702"),
        },
        no_old(),
    )


def coupon_use(lineitem: DataFrame) -> DataFrame:
    """Every line gets a coupon; it is ordered with when discounted and paid with when taxed."""
    base = {
        "id": line_id(),
        "coupon_id": F.col("l_suppkey"),
        "user_id": F.col("l_partkey"),
        "get_time": line_time_text(),
    }
    used = {**base, "order_id": F.col("l_orderkey"), "using_time": line_time_text()}
    nothing = F.lit(None)
    got = change(lineitem, "coupon_use", F.lit("insert"), line_time(), base, no_old())
    ordered = change(
        lineitem.filter(F.col("l_discount") > 0), "coupon_use", F.lit("update"), line_time() + 60,
        used, record_map({"using_time": nothing}),
    )
    paid = change(
        lineitem.filter(F.col("l_tax") > 0), "coupon_use", F.lit("update"), line_time() + 120,
        {**used, "used_time": line_time_text()}, record_map({"used_time": nothing}),
    )
    return got.unionByName(ordered).unionByName(paid)


def comment_info(orders: DataFrame) -> DataFrame:
    return change(
        orders, "comment_info", F.lit("insert"), F.unix_seconds("o_orderdate"),
        {
            "id": F.col("o_orderkey"),
            "user_id": F.col("o_custkey"),
            "sku_id": F.col("o_custkey"),
            "order_id": F.col("o_orderkey"),
            "create_time": second_text(F.col("o_orderdate")),
            "appraise": F.left("o_orderpriority", F.lit(1)),
        },
        no_old(),
    )


def favor_info(events: DataFrame) -> DataFrame:
    """Clicks add a favourite, views add it again, purchases cancel it, other updates are ignored."""
    kind = F.col("event_type")
    old = F.when(kind == "view", record_map({"is_cancel": F.lit("1")})).when(
        kind != "click", record_map({"is_cancel": F.lit("0")}))
    return change(
        events, "favor_info", F.when(kind == "click", "insert").otherwise("update"),
        F.unix_seconds("ts"),
        {
            "id": F.col("event_id"),
            "user_id": F.col("user_id"),
            "sku_id": F.get_json_object("props", "$.k"),
            "create_time": second_text(F.col("ts")),
            "is_cancel": F.when(kind == "purchase", "1").otherwise("0"),
        },
        old,
    )


def user_info(events: DataFrame) -> DataFrame:
    return change(
        events, "user_info",
        F.when(F.col("event_type") == "signup", "insert").otherwise("update"),
        F.unix_seconds("ts"),
        {"id": F.col("event_id"), "create_time": second_text(F.col("ts"))},
        no_old(),
    )


def part_changes(part: DataFrame) -> DataFrame:
    """Snapshot of all parts, a later rename of large ones, deletion of the smallest."""
    data = {
        "p_partkey": F.col("p_partkey"),
        "p_name": F.col("p_name"),
        "p_brand": F.col("p_brand"),
        "p_type": F.col("p_type"),
    }
    renamed = {**data, "p_name": F.upper("p_name")}
    one, two, three = F.lit(1), F.lit(2), F.lit(3)
    snapshot = change(part, "part", F.lit("bootstrap-insert"), one, data, no_old())
    update = change(part.filter("p_size > 25"), "part", F.lit("update"), two, renamed,
                    record_map({"p_name": F.col("p_name")}))
    delete = change(part.filter("p_size = 1"), "part", F.lit("delete"), three, data, no_old())
    return snapshot.unionByName(update).unionByName(delete)


def supplier_changes(supplier: DataFrame) -> DataFrame:
    return change(
        supplier, "supplier", F.lit("insert"), F.lit(1),
        {"s_suppkey": F.col("s_suppkey"), "s_name": F.col("s_name"),
         "s_nationkey": F.col("s_nationkey")},
        no_old(),
    )


def nation_changes(nation: DataFrame) -> DataFrame:
    return change(
        nation, "nation", F.lit("insert"), F.lit(1),
        {"n_nationkey": F.col("n_nationkey"), "n_name": F.col("n_name")}, no_old(),
    )


# Change-log table -> (test table it is derived from, derivation).
CHANGE_TABLES = {
    "order_info": ("orders", order_info),
    "payment_info": ("orders", payment_info),
    "comment_info": ("orders", comment_info),
    "order_detail": ("lineitem", order_detail),
    "order_detail_activity": ("lineitem", order_detail_activity),
    "order_detail_coupon": ("lineitem", order_detail_coupon),
    "cart_info": ("lineitem", cart_info),
    "order_refund_info": ("lineitem", order_refund_info),
    "refund_payment": ("lineitem", refund_payment),
    "coupon_use": ("lineitem", coupon_use),
    "favor_info": ("events", favor_info),
    "user_info": ("events", user_info),
    "part": ("part", part_changes),
    "supplier": ("supplier", supplier_changes),
    "nation": ("nation", nation_changes),
}


def change_log(spark: SparkSession, sf_dir: str, *only: str) -> DataFrame:
    """The change log of the whole shop, or of the named change-log tables.

    A filter on the table name removes the other tables' branches while the query is planned.
    """
    sources: dict[str, DataFrame] = {}
    logs = []
    for name in only or CHANGE_TABLES:
        source, make = CHANGE_TABLES[name]
        if source not in sources:
            sources[source] = table(spark, sf_dir, source)
        logs.append(make(sources[source]))
    return reduce(DataFrame.unionByName, logs)


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration changes: every supplier is one version of its nation's configuration."""
    supplier = table(spark, sf_dir, "supplier")
    nation = text(F.col("s_nationkey"))
    after = F.struct(
        F.concat(F.lit("source_"), nation).alias("source_table"),
        F.concat(F.lit("dim_"), nation).alias("sink_table"),
        F.concat(F.lit("id,c"), text(F.col("s_suppkey"))).alias("sink_columns"),
        F.when(F.col("s_acctbal") > 5000, "id").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"),
    )
    return supplier.select(
        F.lit(None).cast(S.CONFIG_ROW).alias("before"), after.alias("after"),
        F.lit("r").alias("op"), F.col("s_suppkey").alias("ts_ms"),
    )


def dim_config(spark: SparkSession) -> DataFrame:
    """Targets of the two configured tables; nation is left out on purpose."""
    rows = [
        ("part", "dim_part", "p_partkey,p_name,p_brand", "p_partkey", None),
        ("supplier", "dim_supplier", "s_suppkey,s_name", "s_suppkey", None),
    ]
    return spark.createDataFrame(rows, S.CONFIG_ROW)


# --- dictionary and product dimensions ---------------------------------------------------------


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code per order priority; the lowest is left out so that some codes are unknown."""
    orders = table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'")
    code = F.left("o_orderpriority", F.lit(1))
    day = F.col("o_orderdate")
    return orders.groupBy(code.alias("dic_code")).agg(
        F.min(F.substr("o_orderpriority", F.lit(3))).alias("dic_name"),
        F.lit("prio").alias("parent_code"),
        F.min(day).alias("create_time"),
        F.max(day).alias("operate_time"),
    )


def product_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six product dimensions as text columns."""
    part = table(spark, sf_dir, "part")
    supplier, nation, region = (
        table(spark, sf_dir, name) for name in ("supplier", "nation", "region")
    )
    name = F.concat(F.lit("family "), F.col("spu_id"))
    return {
        "sku": part.select(
            text(F.col("p_partkey")).alias("sku_id"),
            F.col("p_type").alias("spu_id"),
            F.col("p_brand").alias("trademark_id"),
            text(F.col("p_size")).alias("category3_id"),
        ),
        "spu": part.select(F.col("p_type").alias("spu_id")).distinct().withColumn(
            "spu_name", name),
        "trademark": part.select(F.col("p_brand").alias("trademark_id")).distinct().withColumn(
            "trademark_name", F.lower("trademark_id")),
        "category3": supplier.select(
            text(F.col("s_suppkey")).alias("category3_id"), F.col("s_name").alias("category3_name"),
            text(F.col("s_nationkey")).alias("category2_id"),
        ),
        "category2": nation.select(
            text(F.col("n_nationkey")).alias("category2_id"),
            F.col("n_name").alias("category2_name"),
            text(F.col("n_regionkey")).alias("category1_id"),
        ),
        "category1": region.select(
            text(F.col("r_regionkey")).alias("category1_id"),
            F.col("r_name").alias("category1_name"),
        ),
    }
