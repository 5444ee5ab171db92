"""Detail layer of the shop's trade tables.

Every function takes the change log (``schemas.CHANGE`` columns) or records of another function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.functions.times import date_id
from tidehouse.functions.values import amount, fields, has_key
from tidehouse.operators.changes import changes_of, increase, increased, moved_to
from tidehouse.operators.keyed import newest_per_key
from tidehouse.operators.lookup import code_names, hot_keys, is_small, lookup, spread_join
from tidehouse.operators.parts import Cut, in_parts

# Order of the versions of one order detail; the later columns only break ties.
DETAIL_VERSION = ("ts", "sku_id", "source_id", "sku_num", "split_total_amount")

# --- fixed values: column order of the order-detail fact ---
WIDE_COLUMNS = [
    "order_detail_id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
    "order_create_time", "source_type", "source_id", "split_original_amount",
    "split_total_amount", "split_activity_amount", "split_coupon_amount", "consignee",
    "consignee_tel", "total_amount", "order_status", "user_id", "payment_way", "out_trade_no",
    "trade_body", "operate_time", "expire_time", "process_status", "tracking_no",
    "parent_order_id", "province_id", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "feight_fee_reduce", "type", "old", "activity_id",
    "activity_rule_id", "activity_create_time", "coupon_id", "coupon_use_id",
    "coupon_create_time", "dic_name", "ts",
]
# --- end of fixed values ---
OFFER_COLUMNS = {
    "activity_id", "activity_rule_id", "activity_create_time", "coupon_id", "coupon_use_id",
    "coupon_create_time",
}


def arrival(changes: DataFrame) -> list[str]:
    """The sequence column, where the source gave one."""
    return ["seq"] if "seq" in changes.columns else []


def cart_additions(changes: DataFrame) -> DataFrame:
    """Cart inserts and raised quantities, with the added quantity as ``sku_num``."""
    rows = changes_of(changes, "cart_info").filter(increased("sku_num"))
    plain = [c for c in S.CART_COLUMNS if c != "sku_num"]
    out = rows.select(
        *fields(F.col("data"), plain), increase("sku_num").alias("sku_num"), "ts"
    )
    return out.select(*S.CART_COLUMNS, "ts")


def cart_add(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Cart additions with the name of their source; unknown sources are dropped."""
    names = code_names(dictionary, "source_type", "dic_name")
    return lookup(cart_additions(changes), names, ["source_type"], ["id"], "inner").select(
        *S.CART_COLUMNS, "dic_name", "ts"
    )


def order_details(changes: DataFrame) -> DataFrame:
    """Inserted order lines with their undiscounted amount."""
    data = F.col("data")
    own = {"id": "order_detail_id", "create_time": "order_create_time"}
    return changes_of(changes, "order_detail", [S.CHANGE_INSERT]).select(
        *[data[c].alias(own.get(c, c)) for c in S.ORDER_DETAIL_COLUMNS],
        amount(data["sku_num"], data["order_price"]).alias("split_original_amount"),
        "ts",
        *arrival(changes),
    )


def order_headers(changes: DataFrame) -> DataFrame:
    """Inserted and updated order headers, one row per change."""
    data = F.col("data")
    return changes_of(changes, "order_info", [S.CHANGE_INSERT, S.CHANGE_UPDATE]).select(
        data["id"].alias("order_id"),
        *fields(data, S.ORDER_INFO_COLUMNS[1:]),
        "type",
        "old",
        F.col("ts").alias("header_ts"),
        *arrival(changes),
    )


def order_activities(changes: DataFrame) -> DataFrame:
    data = F.col("data")
    return changes_of(changes, "order_detail_activity", [S.CHANGE_INSERT]).select(
        *fields(data, ["order_detail_id", "activity_id", "activity_rule_id"]),
        data["create_time"].alias("activity_create_time"),
        F.col("ts").alias("activity_ts"),
        *arrival(changes),
    )


def order_coupons(changes: DataFrame) -> DataFrame:
    data = F.col("data")
    return changes_of(changes, "order_detail_coupon", [S.CHANGE_INSERT]).select(
        *fields(data, ["order_detail_id", "coupon_id", "coupon_use_id"]),
        data["create_time"].alias("coupon_create_time"),
        F.col("ts").alias("coupon_ts"),
        *arrival(changes),
    )


def hot_orders(changes: DataFrame) -> DataFrame:
    """Orders with more lines than one task should join, counted on the raw change log."""
    return hot_keys(order_details(changes).select("order_id"), ["order_id"])


def newest_headers(headers: DataFrame) -> DataFrame:
    return newest_per_key(headers, ["order_id"], ["header_ts", "type"])


def order_detail_wide(
    changes: DataFrame,
    dictionary: DataFrame,
    version: Sequence[str] = DETAIL_VERSION,
    headers: DataFrame | None = None,
    offers: bool = True,
    laid: bool = False,
) -> DataFrame:
    """Order lines with header, activity, coupon and source name; one row per header change.

    Lines, activities and coupons are first reduced to the newest row per order line, so no key
    repeats on either side of these joins, and all three are already laid out by order line: the
    left joins need no shuffle of their own. The source name comes by broadcast before the one
    remaining shuffle, on order_id, in which the lines of a hot order are cut into parts.
    ``offers=False`` leaves the activity and coupon columns, and their two joins, out. ``laid`` writes
    the lines of large tables part by part before that shuffle (``in_parts``).
    """
    line = ["order_detail_id"]

    def joined(cut: Cut) -> DataFrame:
        lines = newest_per_key(cut(order_details(changes)), line, version).drop("ts", "seq")
        if not offers:
            return lines
        activities = newest_per_key(
            cut(order_activities(changes)), line, ["activity_ts", "activity_id", "activity_rule_id"]
        ).drop("seq")
        coupons = newest_per_key(
            cut(order_coupons(changes)), line, ["coupon_ts", "coupon_id", "coupon_use_id"]
        ).drop("seq")
        return lines.join(activities, line, "left").join(coupons, line, "left")

    lines = in_parts(joined, line, "order-lines") if laid else joined(lambda rows: rows)
    named = lookup(lines, code_names(dictionary, "source_type", "dic_name"), ["source_type"],
                   line, "inner")
    headers = order_headers(changes) if headers is None else headers
    headers = headers.withColumnRenamed("header_ts", "ts").drop("seq")
    return spread_join(
        named, headers, ["order_id"], line, "inner", hot_orders(changes)
    ).select(*[c for c in WIDE_COLUMNS if offers or c not in OFFER_COLUMNS])


def order_add(wide: DataFrame) -> DataFrame:
    """Order lines as they were placed."""
    return wide.filter(F.col("type") == S.CHANGE_INSERT)


def order_cancel(wide: DataFrame) -> DataFrame:
    """Order lines of orders that changed to cancelled."""
    return wide.filter(
        (F.col("type") == S.CHANGE_UPDATE)
        & F.col("old")["order_status"].isNotNull()
        & (F.col("order_status") == S.ORDER_CANCELLED)
    )


def payments_done(changes: DataFrame) -> DataFrame:
    """Payments that changed to paid."""
    paid = changes_of(changes, "payment_info").filter(moved_to("payment_status", S.PAYMENT_DONE))
    return paid.select(*fields(F.col("data"), S.PAYMENT_COLUMNS), "ts")


def pay_detail(changes: DataFrame, newest_wide: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid order lines; ``newest_wide`` has one row per order line.

    The lines of a hot order are cut into parts; its payments are copied to them.
    """
    names = code_names(dictionary, "payment_type", "payment_type_name")
    pays = lookup(payments_done(changes), names, ["payment_type"], ["order_id"], "inner")
    return spread_join(
        newest_wide, pays.drop("user_id", "ts"), ["order_id"], ["order_detail_id"], "inner",
        hot_orders(changes),
    ).select(
        "order_detail_id", "order_id", "user_id", "sku_id", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", F.col("payment_type").alias("payment_type_code"),
        "payment_type_name", "callback_time", "source_id", "source_type", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"),
    )


def pay_detail_of(changes: DataFrame, dictionary: DataFrame, laid: bool = False) -> DataFrame:
    """Paid order lines of a change log, with the newest version of each order."""
    newest = newest_headers(order_headers(changes))
    return pay_detail(changes, order_detail_wide(changes, dictionary, headers=newest, laid=laid), dictionary)


def order_refunds(changes: DataFrame) -> DataFrame:
    return changes_of(changes, "order_refund_info", [S.CHANGE_INSERT]).select(
        *fields(F.col("data"), S.ORDER_REFUND_COLUMNS), "ts", *arrival(changes)
    )


def refunding_orders(changes: DataFrame) -> DataFrame:
    """Newest update per order that touched the status and left it at refunding."""
    rows = changes_of(changes, "order_info", [S.CHANGE_UPDATE]).filter(
        (F.col("data")["order_status"] == S.ORDER_REFUNDING)
        & has_key(F.col("old"), "order_status")
    )
    flat = rows.select(
        F.col("data")["id"].alias("order_id"), F.col("data")["province_id"].alias("province_id"),
        "ts", *arrival(changes),
    )
    return newest_per_key(flat, ["order_id"], ["ts", "province_id"]).drop("ts", "seq")


def order_refund_wide(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refund requests with province and the names of their two codes."""
    types = code_names(dictionary, "refund_type", "refund_type_name")
    reasons = code_names(dictionary, "refund_reason_type", "refund_reason_type_name")
    small = is_small(dictionary)
    named = lookup(order_refunds(changes), types, ["refund_type"], ["id"], small=small)
    named = lookup(named, reasons, ["refund_reason_type"], ["id"], small=small)
    return spread_join(
        named, refunding_orders(changes), ["order_id"], ["id"], "left",
        hot_keys(order_refunds(changes).select("order_id"), ["order_id"]),
    ).select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        date_id(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts",
    )


def refund_payments_done(changes: DataFrame) -> DataFrame:
    """Refund payments that succeeded."""
    return changes_of(changes, "refund_payment").filter(
        F.col("data")["refund_status"] == S.REFUND_DONE
    ).select(*fields(F.col("data"), S.REFUND_PAYMENT_COLUMNS), "ts")


def refund_pay_wide(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid refunds with buyer, province and refunded quantity.

    The refund request is reduced to the newest per (order, sku) and the order to its newest
    update, so each refund payment gives at most one row.
    """
    names = code_names(dictionary, "payment_type", "payment_type_name")
    paid = lookup(refund_payments_done(changes), names, ["payment_type"], ["id"], "inner")
    requests = newest_per_key(
        order_refunds(changes).select(
            "order_id", "sku_id", "refund_num", F.col("ts").alias("v"), *arrival(changes)
        ),
        ["order_id", "sku_id"],
        ["v", "refund_num"],
    ).drop("v", "seq")
    updates = changes_of(changes, "order_info", [S.CHANGE_UPDATE]).select(
        F.col("data")["id"].alias("order_id"), F.col("data")["user_id"].alias("user_id"),
        F.col("data")["province_id"].alias("province_id"), F.col("ts").alias("v"),
        *arrival(changes),
    )
    orders = newest_per_key(updates, ["order_id"], ["v", "user_id", "province_id"]).drop("v", "seq")
    keys = refund_payments_done(changes).select("order_id", "sku_id")
    paid = spread_join(
        paid, requests, ["order_id", "sku_id"], ["id", "callback_time"], "inner",
        hot_keys(keys, ["order_id", "sku_id"]),
    )
    return spread_join(
        paid, orders, ["order_id"], ["id", "callback_time"], "inner", hot_keys(keys, ["order_id"])
    ).select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        date_id(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
        F.col("total_amount").alias("refund_amount"), "ts",
    )
