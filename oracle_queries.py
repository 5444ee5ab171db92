"""Reference answers as SQL over the test tables: name -> SQL text."""

from __future__ import annotations


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


# --- shared derivations --------------------------------------------------------------------------

PAGE_COLUMNS = """
  CAST(user_id AS VARCHAR) AS mid,
  CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
  concat('v', user_id % 3) AS vc, concat('c', user_id % 2) AS ch, concat('r', user_id % 4) AS ar,
  CASE WHEN event_id % 4 = 0 THEN '0' ELSE '1' END AS is_new,
  CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'home'
    WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'register' ELSE 'error' END AS page_id,
  CASE event_id % 3 WHEN 1 THEN 'search' WHEN 2 THEN 'home' END AS last_page_id,
  CASE WHEN event_id % 3 = 1
    THEN concat('手机 ', event_type, ' K', props->>'$.k') END AS item,
  CASE WHEN event_id % 3 = 1 THEN 'keyword' END AS item_type,
  CAST(round(CAST(value AS DECIMAL(16,2)) * 100) AS BIGINT) AS during_time
"""
REAL_US = "epoch_us(ts)"
FAST_US = "1704152400000000 + (epoch_us(ts) - 1704067200000000) // 1000"


def _pages(us: str) -> str:
    return f"page_log AS (SELECT event_id, {us} AS us, make_timestamp({us}) AS pts, {PAGE_COLUMNS} FROM events)"


PAGES = _pages(REAL_US)
FAST_PAGES = _pages(FAST_US)

LINE_ID = "concat(l_orderkey, '-', l_linenumber)"
LINE_S = "(epoch(l_shipdate)::BIGINT + l_partkey % 60)"
LINE_TEXT = f"strftime(make_timestamp({LINE_S} * 1000000), '%Y-%m-%d %H:%M:%S')"
PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"
TOTAL = f"CAST({PRICE} * (CAST(1 AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(5,2))) AS VARCHAR)"

DETAIL = f"""order_detail AS (
  SELECT {LINE_ID} AS order_detail_id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, concat('part ', l_partkey) AS sku_name,
    CAST({PRICE} AS VARCHAR) AS order_price, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
    {LINE_TEXT} AS order_create_time, CAST(l_linenumber % 5 AS VARCHAR) AS source_type,
    CAST(l_suppkey AS VARCHAR) AS source_id, {TOTAL} AS split_total_amount,
    CASE WHEN l_returnflag = 'A' THEN '10.00' END AS split_activity_amount,
    CASE WHEN l_discount > 0.05 THEN '5.00' END AS split_coupon_amount,
    CAST(CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * {PRICE} AS VARCHAR) AS split_original_amount,
    {LINE_S} AS ts
  FROM lineitem)"""

NEWEST_DETAIL = """newest_detail AS (
  SELECT * FROM order_detail QUALIFY row_number() OVER (PARTITION BY order_detail_id
    ORDER BY ts DESC, sku_id DESC, source_id DESC, sku_num DESC, split_total_amount DESC) = 1)"""

ACTIVITY = f"""activity AS (
  SELECT {LINE_ID} AS order_detail_id, CAST(l_suppkey AS VARCHAR) AS activity_id,
    CAST(l_partkey AS VARCHAR) AS activity_rule_id, {LINE_TEXT} AS activity_create_time
  FROM lineitem WHERE l_returnflag = 'A'
  QUALIFY row_number() OVER (PARTITION BY order_detail_id
    ORDER BY {LINE_S} DESC, activity_id DESC, activity_rule_id DESC) = 1)"""

COUPON = f"""coupon AS (
  SELECT {LINE_ID} AS order_detail_id, CAST(l_suppkey AS VARCHAR) AS coupon_id,
    CAST(l_partkey AS VARCHAR) AS coupon_use_id, {LINE_TEXT} AS coupon_create_time
  FROM lineitem WHERE l_discount > 0.05
  QUALIFY row_number() OVER (PARTITION BY order_detail_id
    ORDER BY {LINE_S} DESC, coupon_id DESC, coupon_use_id DESC) = 1)"""

HEADER = """header AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, concat('buyer ', o_custkey) AS consignee,
    CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
    CASE k WHEN 'insert' THEN '1001' ELSE
      CASE o_orderstatus WHEN 'O' THEN '1002' WHEN 'F' THEN '1003' ELSE '1005' END
    END AS order_status,
    CAST(o_custkey AS VARCHAR) AS user_id, left(o_orderpriority, 1) AS payment_way,
    CASE k WHEN 'update'
      THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END AS operate_time,
    CAST(o_custkey % 34 AS VARCHAR) AS province_id,
    CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS original_total_amount,
    k AS type, CASE k WHEN 'update' THEN '1001' END AS old_order_status,
    CAST(epoch(o_orderdate) AS BIGINT) + CASE k WHEN 'update' THEN 86400 ELSE 0 END AS header_ts
  FROM orders, (VALUES ('insert'), ('update')) kinds(k))"""

DICTIONARY = """base_dic AS (
  SELECT left(o_orderpriority, 1) AS dic_code, min(substr(o_orderpriority, 3)) AS dic_name,
    min(o_orderdate) AS create_time, max(o_orderdate) AS operate_time
  FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"""

ABSENT = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {name}"
    for name in (
        "consignee_tel", "out_trade_no", "trade_body", "expire_time", "process_status",
        "tracking_no", "parent_order_id", "activity_reduce_amount", "coupon_reduce_amount",
        "feight_fee", "feight_fee_reduce",
    )
)

WIDE = f"""wide AS (
  SELECT d.* EXCLUDE (ts), h.consignee, h.total_amount, h.order_status, h.user_id, h.payment_way,
    h.operate_time, h.province_id, h.original_total_amount, h.type, h.old_order_status,
    a.activity_id, a.activity_rule_id, a.activity_create_time,
    c.coupon_id, c.coupon_use_id, c.coupon_create_time, b.dic_name, h.header_ts AS ts, {ABSENT}
  FROM newest_detail d JOIN header h USING (order_id)
  LEFT JOIN activity a USING (order_detail_id) LEFT JOIN coupon c USING (order_detail_id)
  JOIN base_dic b ON d.source_type = b.dic_code)"""

WIDE_PARTS = (DETAIL, NEWEST_DETAIL, ACTIVITY, COUPON, HEADER, DICTIONARY, WIDE)

CART = f"""cart_add AS (
  SELECT {LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST({PRICE} AS VARCHAR) AS cart_price,
    CAST(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS INT)
      ELSE CAST(l_quantity AS INT) - l_partkey % 50 END AS INT) AS sku_num,
    concat('part ', l_partkey) AS sku_name, '1' AS is_checked,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
    CASE WHEN l_returnflag <> 'N' THEN {LINE_TEXT} END AS operate_time,
    '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time,
    CAST(l_linenumber % 5 AS VARCHAR) AS source_type, CAST(l_suppkey AS VARCHAR) AS source_id,
    {LINE_S} AS ts
  FROM lineitem
  WHERE l_returnflag = 'N' OR (l_linestatus = 'O' AND CAST(l_quantity AS INT) > l_partkey % 50))"""

CART_FACT = """cart_fact AS (
  SELECT c.*, b.dic_name FROM cart_add c JOIN base_dic b ON c.source_type = b.dic_code)"""

REFUND = f"""refund AS (
  SELECT {LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
    CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST(l_linenumber AS VARCHAR) AS refund_type,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS refund_num,
    CAST({PRICE} AS VARCHAR) AS refund_amount, CAST(l_linenumber % 3 AS VARCHAR) AS refund_reason_type,
    concat('reason ', l_suppkey) AS refund_reason_txt, {LINE_TEXT} AS create_time, l_linestatus,
    {LINE_S} AS ts
  FROM lineitem WHERE l_returnflag = 'R')"""

VISITORS = """uv AS (
  SELECT * FROM page_log WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, CAST(pts AS DATE) ORDER BY us, event_id) = 1)"""

JUMPS = """following AS (
  SELECT *, lead(us) OVER w AS next_us, lead(last_page_id IS NULL) OVER w AS next_entry
  FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY us, event_id)),
uj AS (
  SELECT * FROM following WHERE last_page_id IS NULL
    AND (next_us IS NULL OR next_us - us >= 10000000 OR next_entry))"""

UNION_ROWS = """traffic AS (
  SELECT vc, ch, ar, is_new, 0::BIGINT AS uv_ct,
    CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END::BIGINT AS sv_ct, 1::BIGINT AS pv_ct,
    coalesce(during_time, 0)::BIGINT AS dur_sum, 0::BIGINT AS uj_ct, us FROM page_log
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 0, 1, us FROM uj
  UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, us FROM uv)"""


def _window(us: str = "us") -> str:
    """Start of the ten-second window, as microseconds."""
    return f"({us} // 10000000 * 10000000)"


def _stt_edt(us: str = "us") -> str:
    form = "'%Y-%m-%d %H:%M:%S'"
    return (
        f"strftime(make_timestamp({_window(us)}), {form}) AS stt, "
        f"strftime(make_timestamp({_window(us)} + 10000000), {form}) AS edt"
    )


WORDS = r"""words AS (
  SELECT unnest(regexp_extract_all(lower(item), '[a-z0-9]+|[\x{4e00}-\x{9fa5}]')) AS word, us
  FROM page_log WHERE item IS NOT NULL AND last_page_id = 'search' AND item_type = 'keyword')"""

PART_LOG = """changes AS (
  SELECT 'part' AS t, 'bootstrap-insert' AS type, 1 AS ts, CAST(p_partkey AS VARCHAR) AS pk,
    p_name AS name, p_brand AS brand FROM part
  UNION ALL SELECT 'part', 'update', 2, CAST(p_partkey AS VARCHAR), upper(p_name), p_brand
    FROM part WHERE p_size > 25
  UNION ALL SELECT 'supplier', 'insert', 1, CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier),
routed AS (
  SELECT concat('dim_', t) AS sink_table, pk, t AS "table", type, CAST(ts AS BIGINT) AS ts,
    CASE t WHEN 'part'
      THEN concat('{"p_partkey":"', pk, '","p_name":"', name, '","p_brand":"', brand, '"}')
      ELSE concat('{"s_suppkey":"', pk, '","s_name":"', name, '"}') END AS data, name, brand
  FROM changes)"""

NEWEST_DIM = """newest AS (
  SELECT * FROM routed QUALIFY row_number() OVER (PARTITION BY sink_table, pk ORDER BY ts DESC) = 1)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_type AS spu_id,
    concat('family ', p_type) AS spu_name, p_brand AS trademark_id,
    lower(p_brand) AS trademark_name, CAST(p_size AS VARCHAR) AS category3_id,
    s_name AS category3_name, CAST(s_nationkey AS VARCHAR) AS category2_id,
    n_name AS category2_name, CAST(n_regionkey AS VARCHAR) AS category1_id,
    r_name AS category1_name
  FROM part LEFT JOIN supplier ON s_suppkey = p_size
  LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)"""

COMMON = "mid, uid, vc, ch, ar, is_new"
N_ITEMS = "range(1, CAST(event_id % 4 AS INT) + 1)"
BUYERS = """t1 AS (SELECT c_custkey AS id, c_name AS name FROM customer),
t2 AS (SELECT o_custkey AS id, o_orderstatus AS sex FROM orders)"""
SETTLED = """t1 AS (SELECT o_orderkey AS id, o_orderpriority AS name FROM orders WHERE o_orderstatus <> 'P'),
t2 AS (SELECT l_orderkey AS id, min(l_returnflag) AS sex FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)"""


def _coupon_step(name: str, filtered: str, delay: int) -> str:
    return f"""SELECT {LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS coupon_id,
      CAST(l_partkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
      left({LINE_TEXT}, 10) AS date_id, {LINE_TEXT} AS {name}, {LINE_S} + {delay} AS ts
      FROM lineitem WHERE {filtered}"""


def _join(how: str, sides: str = BUYERS) -> str:
    return _with(sides, select=f"SELECT id, name, sex FROM t1 {how} JOIN t2 USING (id)")


SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

ORACLE: dict[str, str] = {
    "src_topic_lines": """SELECT event_id,
        CASE WHEN event_type <> 'error' THEN props ELSE '' END AS value FROM events""",
    "src_topic_json": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders",
    "src_cdc_envelope": _with(HEADER, select="""
        SELECT 'shop' AS database, 'order_info' AS "table", type, header_ts AS ts, order_id AS id,
          order_status, total_amount, CAST(NULL AS VARCHAR) AS payment_status,
          old_order_status AS old_status, TRUE AS has_pt FROM header
        UNION ALL SELECT 'shop', 'payment_info', 'update', CAST(epoch(o_orderdate) AS BIGINT),
          CAST(o_orderkey AS VARCHAR), NULL, NULL,
          CASE WHEN o_orderstatus = 'P' THEN '1601' ELSE '1602' END,
          CASE WHEN o_orderpriority <> '5-LOW' THEN '1601' END, TRUE FROM orders"""),
    "src_config_latest": """SELECT concat('source_', s_nationkey) AS source_table,
          concat('dim_', s_nationkey) AS sink_table, concat('id,c', s_suppkey) AS sink_columns,
          'id' AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend
        FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1""",
    "src_dictionary": _with(DICTIONARY, select="""SELECT dic_code, dic_name, 'prio' AS parent_code,
        strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time,
        strftime(operate_time, '%Y-%m-%d %H:%M:%S') AS operate_time FROM base_dic"""),
    "src_csv_lines": """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(epoch(o_orderdate) AS BIGINT) END AS ts FROM orders""",
    "cdc_project": _with(DETAIL, select="SELECT * FROM order_detail"),
    "cdc_route_insert": """SELECT 'comment_info' AS "table", 'insert' AS type,
        CAST(epoch(o_orderdate) AS BIGINT) AS ts, CAST(o_orderkey AS VARCHAR) AS id,
        CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey AS VARCHAR) AS sku_id,
        CAST(o_orderkey AS VARCHAR) AS order_id,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
        left(o_orderpriority, 1) AS appraise FROM orders""",
    "cdc_route_upsert": _with(HEADER, select="""SELECT order_id, consignee, total_amount,
        order_status, user_id, payment_way, operate_time, province_id, type, header_ts,
        old_order_status FROM header"""),
    "cart_add_delta": _with(CART, select="SELECT * FROM cart_add"),
    "changed_key_filter": f"""SELECT {LINE_ID} AS id, {LINE_S} + 60 AS ts, TRUE AS "using",
          FALSE AS used FROM lineitem WHERE l_discount > 0
        UNION ALL SELECT {LINE_ID}, {LINE_S} + 120, FALSE, TRUE FROM lineitem WHERE l_tax > 0""",
    "favor_add": """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
        props->>'$.k' AS sku_id, strftime(ts, '%Y-%m-%d') AS date_id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, epoch_us(ts) // 1000000 AS ts
        FROM events WHERE event_type IN ('click', 'view')""",
    "coupon_get": f"""SELECT {LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS coupon_id,
        CAST(l_partkey AS VARCHAR) AS user_id, left({LINE_TEXT}, 10) AS date_id,
        {LINE_TEXT} AS get_time, {LINE_S} AS ts FROM lineitem""",
    "coupon_order": _coupon_step("order_time", "l_discount > 0", 60),
    "coupon_pay": _coupon_step("payment_time", "l_tax > 0", 120),
    "user_register": """SELECT CAST(event_id AS VARCHAR) AS user_id,
        strftime(ts, '%Y-%m-%d') AS date_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time,
        epoch_us(ts) // 1000000 AS ts FROM events WHERE event_type = 'signup'""",
    "payment_success": """SELECT CAST(o_custkey AS VARCHAR) AS user_id,
        CAST(o_orderkey AS VARCHAR) AS order_id, left(o_orderpriority, 1) AS payment_type,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS callback_time,
        CAST(epoch(o_orderdate) AS BIGINT) AS ts
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "refund_success": _with(REFUND, select="""SELECT id, order_id, sku_id,
        refund_type AS payment_type, create_time AS callback_time, refund_amount AS total_amount, ts
        FROM refund WHERE l_linestatus = 'F'"""),
    "tombstone_filter": """SELECT CAST(o_orderkey AS VARCHAR) AS order_detail_id, 'insert' AS type
        FROM orders WHERE o_orderstatus = 'F'""",
    "dirty_split": """SELECT 'e' AS origin, event_id AS id, FALSE AS is_dirty,
          CAST(props->>'$.k' AS BIGINT) AS k, md5(props) AS line_md5 FROM events
        UNION ALL SELECT 'd', doc_id, TRUE, NULL, md5(text) FROM documents WHERE text <> ''""",
    "log_split_page": _with(PAGES, select=f"""SELECT {COMMON}, page_id, last_page_id, item,
        item_type, during_time, CASE WHEN page_id = 'error' THEN '{{"error_code":"1001"}}' END AS err,
        us // 1000 AS ts FROM page_log WHERE page_id <> 'register'"""),
    "log_split_start": _with(PAGES, select=f"""SELECT {COMMON}, '{{"entry":"icon"}}' AS start,
        CAST(event_id % 4 AS INT) AS displays, us // 1000 AS ts
        FROM page_log WHERE page_id = 'register'"""),
    "log_split_error": _with(PAGES, select=f"""SELECT {COMMON}, page_id,
        '{{"error_code":"1001"}}' AS err, CAST(event_id % 4 AS INT) AS actions, us // 1000 AS ts
        FROM page_log WHERE page_id = 'error'"""),
    "log_explode_display": _with(PAGES, select=f"""SELECT 'promotion' AS display_type,
        CAST(event_id + i AS VARCHAR) AS item, 'sku_id' AS item_type, CAST(i AS VARCHAR) AS pos_id,
        CAST(i AS VARCHAR) AS "order", page_id, {COMMON}, us // 1000 AS ts
        FROM (SELECT *, unnest({N_ITEMS}) AS i FROM page_log WHERE page_id <> 'register')"""),
    "log_explode_action": _with(PAGES, select=f"""SELECT concat('act', i) AS action_id,
        CAST(event_id * 2 + i AS VARCHAR) AS item, 'sku_id' AS item_type, page_id, {COMMON},
        us // 1000 AS ts
        FROM (SELECT *, unnest({N_ITEMS}) AS i FROM page_log WHERE page_id <> 'register')"""),
    "fix_is_new": _with(PAGES, """marked AS (SELECT *, CAST(pts AS DATE) AS day,
          first_value(CASE WHEN is_new = '1' THEN CAST(pts AS DATE)
            ELSE CAST(pts AS DATE) - 1 END) OVER (PARTITION BY mid ORDER BY us, event_id) AS new_day
          FROM page_log)""", select="""SELECT event_id, mid, page_id,
        CASE WHEN is_new = '1' AND day <> new_day THEN '0' ELSE is_new END AS is_new,
        us // 1000 AS ts FROM marked"""),
    "unique_visitor": _with(PAGES, VISITORS, select="""SELECT event_id, mid, page_id,
        us // 1000 AS ts FROM uv"""),
    "user_jump": _with(FAST_PAGES, JUMPS, select="SELECT event_id, mid, page_id, us AS ts_us FROM uj"),
    "order_detail_inner": _with(DETAIL, NEWEST_DETAIL, HEADER, select="""SELECT order_detail_id,
        order_id, sku_id, split_original_amount, order_status, user_id, type, header_ts
        FROM newest_detail JOIN header USING (order_id)"""),
    "order_detail_wide": _with(*WIDE_PARTS, select="SELECT * FROM wide"),
    "order_add": _with(*WIDE_PARTS, select="SELECT * FROM wide WHERE type = 'insert'"),
    "order_cancel": _with(*WIDE_PARTS, select="""SELECT * FROM wide
        WHERE type = 'update' AND old_order_status IS NOT NULL AND order_status = '1003'"""),
    "pay_detail_wide": _with(*WIDE_PARTS, select="""SELECT w.order_detail_id, w.order_id, w.user_id,
        w.sku_id, w.province_id, w.activity_id, w.activity_rule_id, w.coupon_id,
        left(o.o_orderpriority, 1) AS payment_type_code, b.dic_name AS payment_type_name,
        strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS callback_time, w.source_id, w.source_type,
        w.sku_num, w.split_original_amount, w.split_activity_amount, w.split_coupon_amount,
        w.split_total_amount AS split_payment_amount
        FROM orders o JOIN wide w ON w.order_id = CAST(o.o_orderkey AS VARCHAR)
        JOIN base_dic b ON b.dic_code = left(o.o_orderpriority, 1)
        WHERE w.type = 'update' AND o.o_orderstatus <> 'P' AND o.o_orderpriority <> '5-LOW'"""),
    "order_refund_wide": _with(REFUND, HEADER, DICTIONARY, select="""SELECT r.id, r.user_id,
        r.order_id, r.sku_id, h.province_id, left(r.create_time, 10) AS date_id, r.create_time,
        r.refund_type AS refund_type_code, td.dic_name AS refund_type_name,
        r.refund_reason_type AS refund_reason_type_code, rd.dic_name AS refund_reason_type_name,
        r.refund_reason_txt, r.refund_num, r.refund_amount, r.ts
        FROM refund r
        LEFT JOIN header h ON h.order_id = r.order_id AND h.type = 'update' AND h.order_status = '1005'
        LEFT JOIN base_dic td ON td.dic_code = r.refund_type
        LEFT JOIN base_dic rd ON rd.dic_code = r.refund_reason_type"""),
    "refund_pay_wide": _with(REFUND, HEADER, DICTIONARY, """request AS (
          SELECT order_id, sku_id, refund_num FROM refund
          QUALIFY row_number() OVER (PARTITION BY order_id, sku_id
            ORDER BY ts DESC, refund_num DESC) = 1)""", select="""SELECT p.id, h.user_id, p.order_id,
        p.sku_id, h.province_id, p.refund_type AS payment_type_code,
        b.dic_name AS payment_type_name, left(p.create_time, 10) AS date_id,
        p.create_time AS callback_time, q.refund_num, p.refund_amount, p.ts
        FROM refund p JOIN request q ON q.order_id = p.order_id AND q.sku_id = p.sku_id
        JOIN header h ON h.order_id = p.order_id AND h.type = 'update'
        JOIN base_dic b ON b.dic_code = p.refund_type WHERE p.l_linestatus = 'F'"""),
    "lookup_inner": _with(CART, DICTIONARY, CART_FACT, select="SELECT * FROM cart_fact"),
    "lookup_left": _with(DICTIONARY, select="""SELECT CAST(o_orderkey AS VARCHAR) AS id,
        CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey AS VARCHAR) AS sku_id,
        CAST(o_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS date_id,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
        left(o_orderpriority, 1) AS appraise_code, dic_name AS appraise_name,
        CAST(epoch(o_orderdate) AS BIGINT) AS ts
        FROM orders LEFT JOIN base_dic ON dic_code = left(o_orderpriority, 1)"""),
    "interval_join": _with(FAST_PAGES, select="""SELECT l.mid, l.event_id AS left_id,
        r.event_id AS right_id, r.us - l.us AS gap_us
        FROM page_log l JOIN page_log r ON l.mid = r.mid
          AND r.us BETWEEN l.us - 5000000 AND l.us + 5000000
        WHERE l.page_id = 'home' AND r.page_id = 'good_detail'"""),
    "join_inner": _join("INNER"),
    "join_left": _join("LEFT"),
    "join_right": _join("RIGHT", SETTLED),
    "join_full": _with(SETTLED, select="""SELECT t1.id AS left_id, t2.id AS right_id, name, sex
        FROM t1 FULL JOIN t2 ON t1.id = t2.id"""),
    "dim_route": _with(PART_LOG, select='SELECT sink_table, pk, "table", type, ts FROM routed'),
    "dim_prune_columns": _with(PART_LOG, select="SELECT sink_table, pk, type, data FROM routed"),
    "dim_upsert_latest": _with(PART_LOG, NEWEST_DIM, select="SELECT sink_table, pk, data FROM newest"),
    "dim_schema_from_config": _with(PART_LOG, NEWEST_DIM, select="""SELECT pk AS p_partkey,
        name AS p_name, brand AS p_brand FROM newest WHERE sink_table = 'dim_part'"""),
    "dim_chain_enrich": _with(*WIDE_PARTS, PRODUCTS, select="""SELECT order_detail_id, order_id,
        user_id, p.* REPLACE (w.sku_id AS sku_id) FROM wide w LEFT JOIN products p
        ON p.sku_id = w.sku_id WHERE w.type = 'insert'"""),
    "latest_per_key": _with(DETAIL, NEWEST_DETAIL, select="SELECT * FROM newest_detail"),
    "traffic_union": _with(FAST_PAGES, VISITORS, JUMPS, UNION_ROWS,
                           select="SELECT * EXCLUDE (us), us AS ts FROM traffic"),
    "page_view_window": _with(FAST_PAGES, VISITORS, JUMPS, UNION_ROWS, select=f"""SELECT {_stt_edt()},
        vc, ch, ar, is_new, sum(uv_ct)::BIGINT AS uv_ct, sum(sv_ct)::BIGINT AS sv_ct,
        sum(pv_ct)::BIGINT AS pv_ct, sum(dur_sum)::BIGINT AS dur_sum, sum(uj_ct)::BIGINT AS uj_ct
        FROM traffic GROUP BY ALL"""),
    "keyword_explode": _with(PAGES, WORDS, select="SELECT word, us // 1000 AS ts FROM words"),
    "keyword_window": _with(FAST_PAGES, WORDS, select=f"""SELECT 'search' AS source, {_stt_edt()},
        word AS keyword, count(*) AS keyword_count FROM words GROUP BY ALL"""),
    "home_detail_uv": _with(PAGES, """first_visit AS (
          SELECT * FROM page_log WHERE page_id IN ('home', 'good_detail')
          QUALIFY row_number() OVER (PARTITION BY mid, page_id, CAST(pts AS DATE)
            ORDER BY us, event_id) = 1)""", select=f"""SELECT {_stt_edt()},
        count(*) FILTER (page_id = 'home') AS home_uv_ct,
        count(*) FILTER (page_id <> 'home') AS good_detail_uv_ct
        FROM first_visit GROUP BY ALL"""),
    "user_login": _with(PAGES, """daily AS (
          SELECT uid, us, CAST(pts AS DATE) AS day FROM page_log
          WHERE uid IS NOT NULL AND last_page_id IS NULL
          QUALIFY row_number() OVER (PARTITION BY uid, CAST(pts AS DATE) ORDER BY us, event_id) = 1),
        away AS (SELECT *, day - lag(day) OVER (PARTITION BY uid ORDER BY day) AS days FROM daily)""",
        select=f"""SELECT {_stt_edt()}, count(*) FILTER (days >= 8) AS back_ct, count(*) AS uu_ct
        FROM away GROUP BY ALL"""),
    "cart_uu_window": _with(CART, DICTIONARY, CART_FACT, """timed AS (
          SELECT user_id, id, CAST(coalesce(operate_time, create_time) AS TIMESTAMP) AS t
          FROM cart_fact),
        firsts AS (SELECT epoch_us(t) AS us FROM timed QUALIFY row_number() OVER (
          PARTITION BY user_id, CAST(t AS DATE) ORDER BY t, id) = 1)""",
        select=f"SELECT {_stt_edt()}, count(*) AS cart_add_uu_ct FROM firsts GROUP BY ALL"),
    "user_register_window": f"""SELECT {_stt_edt('epoch_us(ts)')}, count(*) AS register_ct
        FROM events WHERE event_type = 'signup' GROUP BY ALL""",
    "trade_spu_window": _with(*WIDE_PARTS, PRODUCTS, """enriched AS (
          SELECT w.order_id, w.user_id, w.sku_id, p.* EXCLUDE (sku_id),
            epoch_us(CAST(w.order_create_time AS TIMESTAMP)) AS us,
            CAST(w.split_total_amount AS DECIMAL(20,4)) AS amount
          FROM wide w LEFT JOIN products p ON p.sku_id = w.sku_id WHERE w.type = 'insert')""",
        select=f"""SELECT {_stt_edt()}, trademark_id, trademark_name, category1_id, category1_name,
        category2_id, category2_name, category3_id, category3_name, user_id, spu_id, spu_name,
        min(sku_id) AS sku_id, count(DISTINCT order_id) AS order_ct,
        CAST(sum(amount) AS DOUBLE) AS order_amount FROM enriched GROUP BY ALL"""),
    "fn_map_get": f"""SELECT {LINE_ID} AS id, {LINE_S} AS ts,
        CASE WHEN l_returnflag <> 'N' THEN {LINE_TEXT} END AS operate_time,
        CAST(NULL AS VARCHAR) AS absent,
        CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'O'
          THEN CAST(l_partkey % 50 AS VARCHAR) END AS old_sku_num FROM lineitem""",
    "fn_decimal_amount": f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_returnflag <> 'A' THEN
          CAST(CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * {PRICE} AS VARCHAR) END AS amount,
        CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS INT) END AS quantity FROM lineitem""",
    "fn_date_id": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
        THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_id FROM orders""",
    "fn_epoch_to_ts": """SELECT event_id, epoch_us(ts) // 1000000 * 1000000 AS ts_us FROM events""",
    "fn_to_epoch_ms": """SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS full_ms,
        epoch_us(ts) // 86400000000 * 86400000 AS day_ms FROM events""",
    "fn_epoch_format": f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, {SECOND} AS second
        FROM events""",
    "fn_ts_compare": """SELECT event_id, CAST(sign(epoch_us(ts) // 1000 % 1000 -
        CASE WHEN user_id % 100 < 10 THEN user_id % 100 * 100 ELSE user_id % 100 * 10 END) AS INT)
        AS cmp FROM events""",
    "fn_split": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
        CAST(user_id AS VARCHAR) AS second_field, 3 AS fields FROM events""",
    "fn_json": """SELECT event_id, props->>'$.k' AS path_k, 'k' AS keys,
        CAST(props->>'$.k' AS BIGINT) AS k,
        concat('{"next":', CAST(props->>'$.k' AS BIGINT) + 1, '}') AS written FROM events""",
}


# --- streaming queries: windows and rows the watermark has settled -----------------------------


def _closed(us: str, last_us: str, delay_ms: int = 2000) -> str:
    """The ten-second window of ``us`` ends at or before the final watermark."""
    return f"({_window(us)} + 10000000) // 1000 <= {last_us} // 1000 - {delay_ms}"


LAST_PAGE = "(SELECT max(us) FROM page_log)"
# A bounce is written when the mark, two seconds behind the latest page, is ten seconds past it.
SETTLED_JUMPS = f"""settled_uj AS (SELECT * FROM uj
  WHERE us <= {LAST_PAGE} - 12000000)"""
STREAM_UNION = UNION_ROWS.replace("FROM uj", "FROM settled_uj")
HOME_FIRST = """first_visit AS (
  SELECT * FROM page_log WHERE page_id IN ('home', 'good_detail')
  QUALIFY row_number() OVER (PARTITION BY mid, page_id, CAST(pts AS DATE) ORDER BY us, event_id) = 1)"""
LOGIN_DAYS = """daily AS (
  SELECT uid, us, CAST(pts AS DATE) AS day FROM page_log
  WHERE uid IS NOT NULL AND last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY uid, CAST(pts AS DATE) ORDER BY us, event_id) = 1),
away AS (SELECT *, day - lag(day) OVER (PARTITION BY uid ORDER BY day) AS days FROM daily)"""
SIGNUPS = """signups AS (SELECT epoch_us(ts) // 1000000 * 1000000 AS us FROM events
  WHERE event_type = 'signup')"""
TOPIC_ROWS = f"""topics AS (
  SELECT 'page' AS topic, mid, CAST(NULL AS VARCHAR) AS item, us // 1000 AS ts
    FROM page_log WHERE page_id <> 'register'
  UNION ALL SELECT 'start', mid, NULL, us // 1000 FROM page_log WHERE page_id = 'register'
  UNION ALL SELECT 'error', mid, NULL, us // 1000 FROM page_log WHERE page_id = 'error'
  UNION ALL SELECT 'display', mid, CAST(event_id + i AS VARCHAR), us // 1000
    FROM (SELECT *, unnest({N_ITEMS}) AS i FROM page_log WHERE page_id <> 'register')
  UNION ALL SELECT 'action', mid, CAST(event_id * 2 + i AS VARCHAR), us // 1000
    FROM (SELECT *, unnest({N_ITEMS}) AS i FROM page_log WHERE page_id <> 'register'))"""

ORACLE.update(
    {
        "stream_fix_is_new": ORACLE["fix_is_new"],
        "stream_fix_is_new_table": ORACLE["fix_is_new"],
        "stream_unique_visitor": _with(PAGES, select="""SELECT DISTINCT mid,
            strftime(pts, '%Y-%m-%d') AS day FROM page_log WHERE last_page_id IS NULL"""),
        "stream_user_jump": _with(FAST_PAGES, JUMPS, SETTLED_JUMPS,
                                  select="SELECT event_id, mid, us AS ts_us FROM settled_uj"),
        "stream_cart_first": _with(CART, select="""SELECT DISTINCT user_id,
            left(coalesce(operate_time, create_time), 10) AS cart_day FROM cart_add"""),
        "stream_interval_join": ORACLE["interval_join"],
        "stream_left_join": _with(FAST_PAGES, """clicks AS (
              SELECT mid, event_id AS left_id, us FROM page_log WHERE page_id = 'home'),
            views AS (
              SELECT mid, event_id AS right_id, us FROM page_log WHERE page_id = 'good_detail'),
            passed AS (SELECT least((SELECT max(us) FROM clicks), (SELECT max(us) FROM views))
              // 1000 AS ms),
            joined AS (SELECT c.mid, left_id, right_id, c.us FROM clicks c LEFT JOIN views v
              ON c.mid = v.mid AND v.us BETWEEN c.us - 5000000 AND c.us + 5000000)""",
            select="""SELECT mid, left_id, right_id FROM joined, passed
            WHERE right_id IS NOT NULL OR us // 1000 + 5000 < ms"""),
        "stream_full_join": _with(FAST_PAGES, """clicks AS (
              SELECT mid, event_id AS left_id, us FROM page_log WHERE page_id = 'home'),
            views AS (
              SELECT mid, event_id AS right_id, us FROM page_log WHERE page_id = 'good_detail'),
            passed AS (SELECT least((SELECT max(us) FROM clicks), (SELECT max(us) FROM views))
              // 1000 AS ms),
            joined AS (SELECT coalesce(c.mid, v.mid) AS mid, left_id, right_id,
                coalesce(c.us, v.us) AS us
              FROM clicks c FULL JOIN views v
              ON c.mid = v.mid AND v.us BETWEEN c.us - 5000000 AND c.us + 5000000)""",
            select="""SELECT mid, left_id, right_id FROM joined, passed
            WHERE (left_id IS NOT NULL AND right_id IS NOT NULL) OR us // 1000 + 5000 < ms"""),
        "stream_lookup": ORACLE["lookup_inner"],
        "keyword_sql_function": ORACLE["keyword_explode"],
        "stream_page_view_window": _with(FAST_PAGES, VISITORS, JUMPS, SETTLED_JUMPS, STREAM_UNION,
            select=f"""SELECT {_stt_edt()}, vc, ch, ar, is_new, sum(uv_ct)::BIGINT AS uv_ct,
            sum(sv_ct)::BIGINT AS sv_ct, sum(pv_ct)::BIGINT AS pv_ct,
            sum(dur_sum)::BIGINT AS dur_sum, sum(uj_ct)::BIGINT AS uj_ct
            FROM traffic WHERE {_closed('us', LAST_PAGE, 13000)} GROUP BY ALL"""),
        "stream_keyword_window": _with(FAST_PAGES, WORDS, select=f"""SELECT 'search' AS source,
            {_stt_edt()}, word AS keyword, count(*) AS keyword_count FROM words
            WHERE {_closed('us', '(SELECT max(us) // 1000000 * 1000000 FROM words)')}
            GROUP BY ALL"""),
        "stream_home_detail": _with(PAGES, HOME_FIRST, select=f"""SELECT {_stt_edt()},
            count(*) FILTER (page_id = 'home') AS home_uv_ct,
            count(*) FILTER (page_id <> 'home') AS good_detail_uv_ct FROM first_visit
            WHERE {_closed('us', '(SELECT max(us) FROM first_visit)')} GROUP BY ALL"""),
        "stream_user_login": _with(PAGES, LOGIN_DAYS, select=f"""SELECT {_stt_edt()},
            count(*) FILTER (days >= 8) AS back_ct, count(*) AS uu_ct FROM away
            WHERE {_closed('us', '(SELECT max(us) FROM away)')} GROUP BY ALL"""),
        "stream_newest": _with(FAST_PAGES, """spaced AS (
              SELECT *, lead(us) OVER (PARTITION BY mid ORDER BY us, event_id) AS next_us
              FROM page_log)""", select=f"""SELECT mid, us, event_id, page_id FROM spaced
            WHERE (next_us IS NULL OR next_us - us > 2000000)
              AND (us + 2000000) // 1000 <= {LAST_PAGE} // 1000 - 2000"""),
        "sink_append": _with(PAGES, select="""SELECT event_id, mid, page_id, last_page_id
            FROM page_log"""),
        "sink_upsert_latest": _with(HEADER, select="""SELECT order_id, order_status, user_id, type,
            header_ts FROM header WHERE type = 'update'"""),
        "sink_window_result": _with(SIGNUPS, select=f"""SELECT {_stt_edt()},
            count(*) AS register_ct FROM signups
            WHERE {_closed('us', '(SELECT max(us) FROM signups)')} GROUP BY ALL"""),
        "sink_dimensions": _with(PART_LOG, NEWEST_DIM, select="""SELECT sink_table, pk, type, data
            FROM newest WHERE sink_table = 'dim_part'"""),
        "sink_fan_out": _with(PAGES, TOPIC_ROWS, select="SELECT * FROM topics"),
        "late_rows_dropped": _with("""late AS (SELECT epoch_us(ts) AS us FROM events
            WHERE ts >= TIMESTAMP '2024-01-16')""", select=f"""SELECT {_stt_edt()},
            count(*) AS event_ct FROM late
            WHERE {_closed('us', '(SELECT max(us) FROM late)')} GROUP BY ALL"""),
    }
)

# Streams from the change log on have the tables' answers.
ORACLE.update(
    {
        "stream_unique_visitor_first": _with(PAGES, VISITORS, select="""SELECT mid, event_id,
            strftime(pts, '%Y-%m-%d') AS day FROM uv"""),
        "stream_order_detail": ORACLE["order_detail_wide"],
        "stream_order_add": ORACLE["order_add"],
        "stream_order_cancel": ORACLE["order_cancel"],
        "stream_pay_detail": ORACLE["pay_detail_wide"],
        "stream_order_refund": ORACLE["order_refund_wide"],
        "stream_refund_pay": ORACLE["refund_pay_wide"],
        "stream_trade_spu_window": ORACLE["trade_spu_window"],
        "stream_cart_uu_window": ORACLE["cart_uu_window"],
        "fn_proc_time": "SELECT o_orderkey, true AS same_second, true AS same_milli FROM orders",
        "fact_join_left": """SELECT c_custkey, o_orderkey, c_name AS name, o_orderstatus AS status
            FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
        "fact_join_full": """SELECT c_custkey, o_orderkey, c_name AS name, o_orderstatus AS status
            FROM customer FULL JOIN orders ON o_custkey = c_custkey""",
        "newest_by_arrival": """SELECT o_custkey AS order_id, max(o_orderkey) AS last
            FROM orders GROUP BY ALL""",
    }
)

# Jobs have the tables' answers; where rows come in deliveries, the answer says what each delivery brought.
CHUNK = "least((day(pts) - 1) // 5, 5)"
ORACLE.update(
    {
        "stream_right_join": f"""SELECT mid, left_id, right_id FROM ({ORACLE['stream_full_join']}) WHERE right_id IS NOT NULL""",
        "job_cart_add": ORACLE["lookup_inner"],
        "job_coupon_get": ORACLE["coupon_get"],
        "job_coupon_order": ORACLE["coupon_order"],
        "job_coupon_pay": ORACLE["coupon_pay"],
        "job_favor_add": ORACLE["favor_add"],
        "job_comments": ORACLE["lookup_left"],
        "job_registrations": ORACLE["user_register"],
        "job_order_add": ORACLE["order_add"],
        "job_order_cancel": ORACLE["order_cancel"],
        "job_log_split": ORACLE["sink_fan_out"],
        "job_keyword_window": ORACLE["keyword_window"],
        "job_register_window": ORACLE["user_register_window"],
        "job_user_login_window": ORACLE["user_login"],
        "stream_hop_once": ORACLE["home_detail_uv"],
        "stream_regular_left": ORACLE["fact_join_left"],
        "stream_regular_full": ORACLE["fact_join_full"],
        "changelog_window": ORACLE["trade_spu_window"],
        "changelog_left_join": """WITH dealt AS (
            SELECT *, CAST(year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders) + 1 AS BIGINT) AS batch FROM orders)
            SELECT '+I' AS kind, CAST(0 AS BIGINT) AS batch, c_custkey, c_name AS name, CAST(NULL AS BIGINT) AS o_orderkey,
              CAST(NULL AS VARCHAR) AS status FROM customer
            UNION ALL SELECT '+I', batch, c_custkey, c_name, o_orderkey, o_orderstatus FROM dealt JOIN customer ON o_custkey = c_custkey
            UNION ALL SELECT '-D', min(batch), c_custkey, c_name, NULL, NULL
              FROM dealt JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name""",
        "pattern_bounces": ORACLE["user_jump"],
        "pattern_search_view_pay": _with(FAST_PAGES, """following AS (
              SELECT mid, event_id, us, last_page_id = 'search' AS starts, lead(us, 1) OVER w - us < 20000000 AS in1,
                lead(us, 2) OVER w - us < 20000000 AS in2, lead(page_id, 1) OVER w = 'good_detail' AS ok1,
                lead(page_id, 2) OVER w = 'payment' AS ok2, lead(event_id, 1) OVER w AS id1, lead(event_id, 2) OVER w AS id2
              FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY us, event_id)),
            tried AS (SELECT mid, event_id, id1, id2, CASE WHEN NOT coalesce(in1, false) THEN 't1' WHEN NOT ok1 THEN 'x'
                WHEN NOT coalesce(in2, false) THEN 't2' WHEN NOT ok2 THEN 'x' ELSE 'm' END AS state FROM following WHERE starts)""",
            select="""SELECT mid, CASE state WHEN 'm' THEN 'match' ELSE 'timeout' END AS outcome,
            CAST(CASE state WHEN 't1' THEN 1 WHEN 't2' THEN 2 ELSE 3 END AS INT) AS reached, event_id AS search_id,
            CASE WHEN state <> 't1' THEN id1 END AS view_id, CASE WHEN state = 'm' THEN id2 END AS pay_id FROM tried WHERE state <> 'x'"""),
        "dim_route_as_of": """WITH versions AS (
              SELECT s_nationkey AS n, s_suppkey AS sup, s_acctbal > 5000 AS log,
                row_number() OVER w AS k, s_suppkey AS since, lead(s_suppkey) OVER w AS until
              FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_suppkey))
            SELECT concat('dim_', n) AS sink_table, CAST(c_custkey AS VARCHAR) AS pk, concat('source_', n) AS "table",
              CAST(c_custkey % 120 AS BIGINT) AS ts, concat('{"id":"', c_custkey, '"}') AS data
            FROM customer JOIN versions ON n = c_nationkey AND c_custkey % 120 < coalesce(until, 1000000000)
              AND (c_custkey % 120 >= since OR k = 1 AND NOT log)""",
        "sink_upsert_deletions": """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AND o_orderstatus <> 'F'""",
        "job_dimensions": ORACLE["dim_upsert_latest"],
        "late_rows_kept": f"""WITH early AS (SELECT epoch_us(ts) AS us FROM events WHERE ts < TIMESTAMP '2024-01-16'),
            mark AS (SELECT max({_window('epoch_us(ts)')}) AS us FROM events WHERE ts >= TIMESTAMP '2024-01-16')
            SELECT {_stt_edt('early.us')}, count(*) AS event_ct FROM early, mark
            WHERE {_window('early.us')} < mark.us - 2000000 GROUP BY ALL""",
        "stream_first_deadline": _with(PAGES, f"""dealt AS (SELECT *, {CHUNK} AS chunk FROM page_log)""",
            """clock AS (SELECT chunk, max(us) AS us FROM dealt GROUP BY chunk)""",
            """opened AS (SELECT mid, min(chunk) AS chunk FROM dealt GROUP BY mid)""",
            """due AS (SELECT o.mid, min(later.chunk) AS chunk FROM opened o JOIN clock first ON first.chunk = o.chunk
              JOIN clock later ON later.chunk > o.chunk AND later.us - 864000000000 >= first.us GROUP BY o.mid)""",
            select="""SELECT d.mid, event_id, page_id, CAST(due.chunk AS BIGINT) AS batch
            FROM dealt d JOIN due ON due.mid = d.mid AND d.chunk < due.chunk
            QUALIFY row_number() OVER (PARTITION BY d.mid ORDER BY us DESC, event_id DESC) = 1"""),
    }
)
