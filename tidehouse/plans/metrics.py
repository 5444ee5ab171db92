"""Window layer: ten-second summaries of the detail layer.

All functions run on tables and on watermarked streams unless they say otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.functions.times import from_epoch_ms_whole_seconds
from tidehouse.functions.values import first_token, money, words
from tidehouse.operators.keyed import first_per_day, first_per_key
from tidehouse.operators.visits import logins
from tidehouse.operators.windows import tumble, tumble_sums
from tidehouse.plans.traffic import entry_pages

# --- fixed values: columns of the window tables ---
TRAFFIC_DIMS = ["vc", "ch", "ar", "is_new"]
TRAFFIC_MEASURES = ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
PRODUCT_IDS = ["trademark_id", "category3_id", "user_id", "spu_id"]
SPU_COLUMNS = [
    "stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
    "category2_id", "category2_name", "category3_id", "category3_name", "user_id", "spu_id",
    "spu_name", "sku_id", "order_ct", "order_amount",
]
# --- end of fixed values ---


def _traffic_rows(rows: DataFrame, **counters: Column) -> DataFrame:
    zero = F.lit(0).cast("long")
    measures = [
        counters.get(name, zero).cast("long").alias(name) for name in TRAFFIC_MEASURES
    ]
    return rows.select(*TRAFFIC_DIMS, *measures, "ts")


def traffic_union(pages: DataFrame, visitors: DataFrame, jumps: DataFrame) -> DataFrame:
    """Page views, unique visitors and bounces in one shape of counters."""
    one = F.lit(1)
    views = _traffic_rows(
        pages,
        pv_ct=one,
        sv_ct=F.col("last_page_id").isNull().cast("long"),
        dur_sum=F.coalesce("during_time", F.lit(0)),
    )
    return views.unionByName(_traffic_rows(jumps, uj_ct=one)).unionByName(
        _traffic_rows(visitors, uv_ct=one)
    )


def page_view_window(union: DataFrame) -> DataFrame:
    """Traffic counters per window, version, channel, area and visitor kind."""
    return tumble_sums(union, TRAFFIC_MEASURES, TRAFFIC_DIMS)


def search_keywords(pages: DataFrame) -> DataFrame:
    """Searched texts."""
    return pages.filter(
        F.col("item").isNotNull()
        & (F.col("last_page_id") == S.PAGE_SEARCH)
        & (F.col("item_type") == S.ITEM_KEYWORD)
    ).select(F.col("item").alias("key_word"), "ts")


def keyword_words(keywords: DataFrame) -> DataFrame:
    """One row per word of every searched text."""
    return keywords.select(F.explode(words(F.col("key_word"))).alias("word"), "ts")


def keyword_window(word_rows: DataFrame) -> DataFrame:
    """Searches per window and word; event time is cut to the second."""
    counted = tumble(
        word_rows.withColumnRenamed("word", "keyword"),
        {"keyword_count": F.count(F.lit(1))},
        ["keyword"],
    )
    return counted.select(
        F.lit(S.PAGE_SEARCH).alias("source"), "stt", "edt", "keyword", "keyword_count"
    )


def whole_second_pages(pages: DataFrame) -> DataFrame:
    """Pages whose time is cut to the second, as the keyword table declares it."""
    return pages.withColumn("ts", from_epoch_ms_whole_seconds(F.unix_millis("ts")))


def home_detail_first_visits(pages: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """First daily visit of the home and of the detail page per visitor (tables only)."""
    two = pages.filter(F.col("page_id").isin(S.PAGE_HOME, S.PAGE_DETAIL))
    return first_per_day(two, ["mid", "page_id"], "ts", tie)


def home_detail_window(first_visits: DataFrame) -> DataFrame:
    home = (F.col("page_id") == S.PAGE_HOME).cast("long")
    return tumble(
        first_visits,
        {"home_uv_ct": F.sum(home), "good_detail_uv_ct": F.sum(F.lit(1) - home)},
    )


def user_logins(pages: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """First daily session entry of every known user, with the returning flag (tables only)."""
    return logins(entry_pages(pages).filter(F.col("uid").isNotNull()), "ts", tie)


def user_login_window(daily: DataFrame) -> DataFrame:
    return tumble_sums(daily, ["back_ct", "uu_ct"])


def with_cart_time(additions: DataFrame) -> DataFrame:
    """Adds ``cart_time`` (last change as text), its day and the event time ``event_ts``."""
    when = F.coalesce("operate_time", "create_time")
    return additions.withColumns(
        {
            "cart_time": when,
            "cart_day": first_token(when),
            "event_ts": F.try_to_timestamp(when, F.lit(S.SECOND_FORMAT)),
        }
    )


def cart_first_of_day(additions: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """First cart addition of every (user, day) (tables only)."""
    timed = with_cart_time(additions)
    return first_per_key(timed, ["user_id", "cart_day"], ["event_ts", *tie])


def cart_user_window(first_additions: DataFrame) -> DataFrame:
    return tumble(first_additions, {"cart_add_uu_ct": F.count(F.lit(1))}, ts="event_ts")


def register_window(registered: DataFrame) -> DataFrame:
    """Registrations per window; ``ts`` is in epoch seconds."""
    timed = registered.withColumn("event_ts", F.timestamp_seconds("ts"))
    return tumble(timed, {"register_ct": F.count(F.lit(1))}, ts="event_ts")


def order_lines_for_window(lines: DataFrame) -> DataFrame:
    """Order lines (newest per line) with an exact amount and their event time."""
    return lines.select(
        "order_id",
        "sku_id",
        "user_id",
        money(F.col("split_total_amount")).alias("amount"),
        F.try_to_timestamp("order_create_time", F.lit(S.SECOND_FORMAT)).alias("event_ts"),
    )


def spu_order_parts(enriched: DataFrame, signs: Column | None = None) -> DataFrame:
    """Lines and amount per window, product family, order and sku; parts add up, and rows with a negative sign subtract."""
    one = F.lit(1) if signs is None else signs
    amount = F.when(one < 0, -F.col("amount")).otherwise(F.col("amount"))
    parts = enriched.groupBy(F.window("event_ts", "10 seconds").alias("w"), *PRODUCT_IDS, "order_id", "sku_id").agg(
        F.sum(one.cast("long")).alias("lines"), F.sum(amount).alias("amount")
    )
    text = [F.date_format(f"w.{side}", S.SECOND_FORMAT).alias(name) for side, name in (("start", "stt"), ("end", "edt"))]
    return parts.select(*text, *PRODUCT_IDS, "order_id", "sku_id", "lines", "amount")


def spu_order_of_parts(parts: DataFrame) -> DataFrame:
    """The window table of ``spu_order_window`` from added-up parts."""
    keys = ["stt", "edt", *PRODUCT_IDS]
    per_order = parts.filter("lines > 0").groupBy(*keys, "order_id").agg(F.sum("amount").alias("amount"), F.min("sku_id").alias("sku_id"))
    return per_order.groupBy(*keys).agg(
        F.min("sku_id").alias("sku_id"), F.count("order_id").alias("order_ct"), F.sum("amount").cast("double").alias("order_amount")
    )


def spu_order_window(enriched: DataFrame) -> DataFrame:
    """Orders and amount per window, user and product family, by ids.

    Rows are first added up per order, then per window, so distinct orders are counted without
    gathering the order ids of a group. Of several skus of a group the smallest id is shown. Names
    and upper categories follow from the ids and are joined to the finished groups
    (``dimensions.with_product_names``), which keeps the shuffled keys short.
    """
    per_order = (
        enriched.groupBy(F.window("event_ts", "10 seconds").alias("w"), *PRODUCT_IDS, "order_id")
        .agg(F.sum("amount").alias("amount"), F.min("sku_id").alias("sku_id"))
    )
    counted = per_order.groupBy("w", *PRODUCT_IDS).agg(
        F.min("sku_id").alias("sku_id"),
        F.count("order_id").alias("order_ct"),
        F.sum("amount").cast("double").alias("order_amount"),
    )
    return counted.select(
        F.date_format("w.start", S.SECOND_FORMAT).alias("stt"),
        F.date_format("w.end", S.SECOND_FORMAT).alias("edt"),
        *PRODUCT_IDS, "sku_id", "order_ct", "order_amount",
    )
