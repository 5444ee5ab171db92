"""Record shapes and fixed values shared by the batch and streaming transforms."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: codes, page names and change types carried by the shop's own records ---
ORDER_CANCELLED = "1003"
ORDER_REFUNDING = "1005"
PAYMENT_DONE = "1602"
REFUND_DONE = "0701"
PAGE_HOME = "home"
PAGE_DETAIL = "good_detail"
PAGE_SEARCH = "search"
ITEM_KEYWORD = "keyword"
CHANGE_INSERT = "insert"
CHANGE_UPDATE = "update"
DIM_CHANGE_TYPES = ("bootstrap-insert", "insert", "update")
DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
# --- end of fixed values ---

DATABASE = "shop"

STRING_MAP = T.MapType(T.StringType(), T.StringType())

# One change record of any table; numbers inside data/old arrive as strings.
CHANGE = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("data", STRING_MAP),
        T.StructField("old", STRING_MAP),
    ]
)

CONFIG_ROW = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("sink_table", T.StringType()),
        T.StructField("sink_columns", T.StringType()),
        T.StructField("sink_pk", T.StringType()),
        T.StructField("sink_extend", T.StringType()),
    ]
)

CONFIG_CHANGE = T.StructType(
    [
        T.StructField("before", CONFIG_ROW),
        T.StructField("after", CONFIG_ROW),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

COMMON = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("mid", "uid", "vc", "ch", "ar", "is_new")]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.StringType()),
        T.StructField("last_page_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("during_time", T.LongType()),
    ]
)

DISPLAY = T.StructType(
    [
        T.StructField("display_type", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("pos_id", T.StringType()),
        T.StructField("order", T.StringType()),
    ]
)

ACTION = T.StructType(
    [
        T.StructField("action_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

# start and err stay raw JSON text: only their presence decides the route.
APP_LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", T.StringType()),
        T.StructField("err", T.StringType()),
        T.StructField("displays", T.ArrayType(DISPLAY)),
        T.StructField("actions", T.ArrayType(ACTION)),
        T.StructField("ts", T.LongType()),
    ]
)

DICTIONARY = T.StructType(
    [
        T.StructField("dic_code", T.StringType()),
        T.StructField("dic_name", T.StringType()),
        T.StructField("parent_code", T.StringType()),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("operate_time", T.TimestampType()),
    ]
)

# --- fixed values: column lists of the fact records ---
ORDER_DETAIL_COLUMNS = [
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
    "source_type", "source_id", "split_total_amount", "split_activity_amount",
    "split_coupon_amount",
]
ORDER_INFO_COLUMNS = [
    "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way",
    "out_trade_no", "trade_body", "operate_time", "expire_time", "process_status", "tracking_no",
    "parent_order_id", "province_id", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "feight_fee_reduce",
]
CART_COLUMNS = [
    "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "create_time",
    "operate_time", "is_ordered", "order_time", "source_type", "source_id",
]
ORDER_REFUND_COLUMNS = [
    "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
    "refund_reason_type", "refund_reason_txt", "create_time",
]
REFUND_PAYMENT_COLUMNS = [
    "id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount",
]
PAYMENT_COLUMNS = ["user_id", "order_id", "payment_type", "callback_time"]
COMMENT_COLUMNS = ["id", "user_id", "sku_id", "order_id", "create_time", "appraise"]
# --- end of fixed values ---
