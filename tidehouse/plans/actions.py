"""Detail layer of coupons, favourites, comments and registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.functions.times import date_id
from tidehouse.functions.values import fields, has_key
from tidehouse.operators.changes import changes_of
from tidehouse.operators.lookup import code_names, lookup


def coupon_get(changes: DataFrame) -> DataFrame:
    """Coupons handed out."""
    data = F.col("data")
    return changes_of(changes, "coupon_use", [S.CHANGE_INSERT]).select(
        *fields(data, ["id", "coupon_id", "user_id"]),
        date_id(data["get_time"]).alias("date_id"),
        data["get_time"].alias("get_time"),
        "ts",
    )


def _coupon_step(changes: DataFrame, column: str, name: str) -> DataFrame:
    data = F.col("data")
    touched = changes_of(changes, "coupon_use", [S.CHANGE_UPDATE]).filter(
        has_key(F.col("old"), column)
    )
    return touched.select(
        *fields(data, ["id", "coupon_id", "user_id", "order_id"]),
        date_id(data[column]).alias("date_id"),
        data[column].alias(name),
        "ts",
    )


def coupon_order(changes: DataFrame) -> DataFrame:
    """Coupons put on an order: updates that touched the using time."""
    return _coupon_step(changes, "using_time", "order_time")


def coupon_pay(changes: DataFrame) -> DataFrame:
    """Coupons paid with: updates that touched the used time."""
    return _coupon_step(changes, "used_time", "payment_time")


def favor_add(changes: DataFrame) -> DataFrame:
    """Favourites added, or added again after a cancellation."""
    data = F.col("data")
    again = (
        (F.col("type") == S.CHANGE_UPDATE)
        & (F.col("old")["is_cancel"] == "1")
        & (data["is_cancel"] == "0")
    )
    return (
        changes_of(changes, "favor_info")
        .filter((F.col("type") == S.CHANGE_INSERT) | again)
        .select(
            *fields(data, ["id", "user_id", "sku_id"]),
            date_id(data["create_time"]).alias("date_id"),
            data["create_time"].alias("create_time"),
            "ts",
        )
    )


def comments(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal; unknown codes keep a null name."""
    rows = changes_of(changes, "comment_info", [S.CHANGE_INSERT]).select(
        *fields(F.col("data"), S.COMMENT_COLUMNS), "ts"
    )
    named = lookup(rows, code_names(dictionary, "appraise", "appraise_name"), ["appraise"], ["id"])
    return named.select(
        "id", "user_id", "sku_id", "order_id", date_id(F.col("create_time")).alias("date_id"),
        "create_time", F.col("appraise").alias("appraise_code"), "appraise_name", "ts",
    )


def registrations(changes: DataFrame) -> DataFrame:
    data = F.col("data")
    return changes_of(changes, "user_info", [S.CHANGE_INSERT]).select(
        data["id"].alias("user_id"),
        date_id(data["create_time"]).alias("date_id"),
        data["create_time"].alias("create_time"),
        "ts",
    )
