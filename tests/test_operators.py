"""Operators against hand-derived or brute-force results, with hot keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.operators import lookup as L
from tidehouse.operators.intervals import bounced_entries, interval_join
from tidehouse.operators.keyed import newest_per_key
from tidehouse.operators.visits import fix_is_new, logins
from tidehouse.plans import actions, metrics, trade

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds: float) -> dt.datetime:
    return BASE + dt.timedelta(seconds=seconds)


def change(table, kind, data, old=None, ts=1, database=S.DATABASE):
    return (database, table, kind, ts, data, old)


def changes(spark, rows):
    return spark.createDataFrame(rows, S.CHANGE)


def test_interval_join_includes_both_ends(spark):
    left = spark.createDataFrame([("1001", at(15), 15), ("1001", at(21), 21)],
                                 "id string, lt timestamp, l int")
    right = spark.createDataFrame([("1001", at(s), s) for s in (10, 20, 21)],
                                  "id string, rt timestamp, r int")
    got = interval_join(left, right, ["id"], "lt", "rt", -5, 5)
    assert sorted((r.l, r.r) for r in got.collect()) == [(15, 10), (15, 20), (21, 20), (21, 21)]


@pytest.mark.parametrize("bounds", [(-5, 5), (0, 7), (-9, -2), (3, 3)])
def test_interval_join_brute_force_with_hot_key(spark, bounds):
    rng = random.Random(7)

    def side(n):
        return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(9)}", rng.randrange(600), i)
                for i in range(n)]

    a, b = side(300), side(300)
    low, high = bounds
    expected = sorted((x[2], y[2]) for x in a for y in b
                      if x[0] == y[0] and low <= y[1] - x[1] <= high)
    left = spark.createDataFrame([(k, at(s), i) for k, s, i in a], "k string, lt timestamp, l int")
    right = spark.createDataFrame([(k, at(s), i) for k, s, i in b], "k string, rt timestamp, r int")
    got = interval_join(left, right, ["k"], "lt", "rt", low, high).select("l", "r").collect()
    assert sorted((r.l, r.r) for r in got) == expected


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, mid, at(s), last) for i, (mid, s, last) in enumerate(rows)],
        "event_id int, mid string, ts timestamp, last_page_id string")


def test_bounce_rules(spark):
    rows = [
        ("a", 0, None), ("a", 5, "home"),          # followed by a page: no bounce
        ("b", 0, None), ("b", 5, None),            # entry again: bounce; second never followed
        ("c", 0, None), ("c", 10, "home"),         # ten seconds are too late: bounce
        ("d", 0, None), ("d", 9.999, "home"),      # just in time
        ("e", 59, None), ("e", 61, "home"),        # across a slice border
        ("f", 0, "home"),                          # no entry
    ]
    got = {r.event_id for r in bounced_entries(pages(spark, rows), tie=["event_id"]).collect()}
    assert got == {2, 3, 4}


def test_bounce_brute_force_with_hot_visitor(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"m{rng.randrange(20)}", rng.randrange(4000) / 2,
             None if rng.random() < 0.6 else "home") for _ in range(900)]
    by_mid = defaultdict(list)
    for i, (mid, s, last) in enumerate(rows):
        by_mid[mid].append((s, i, last))
    expected = set()
    for events in by_mid.values():
        events.sort(key=lambda e: e[:2])
        for e, n in zip(events, [*events[1:], None]):
            if e[2] is None and (n is None or n[0] - e[0] >= 10 or n[2] is None):
                expected.add(e[1])
    got = [r.event_id for r in bounced_entries(pages(spark, rows), tie=["event_id"]).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_fix_is_new_cases(spark):
    day = 86400
    rows = [
        ("a", 0, "1"), ("a", 100, "1"), ("a", day, "1"), ("a", 2 * day, "0"),
        ("b", 0, "0"), ("b", 10, "1"), ("b", day, "1"),
        ("c", 5 * day, "1"),
    ]
    df = spark.createDataFrame([(i, m, at(s), n) for i, (m, s, n) in enumerate(rows)],
                               "event_id int, mid string, ts timestamp, is_new string")
    expected = ["1", "1", "0", "0", "0", "0", "0", "1"]
    for rows_per_task in (2_000_000, 1):
        got = fix_is_new(df, "ts", ["event_id"], rows_per_task=rows_per_task)
        assert [r.is_new for r in got.orderBy("event_id").collect()] == expected


def test_login_returns_after_eight_days(spark):
    day = 86400
    rows = [("u", 0), ("u", 50), ("u", 3 * day), ("u", 10 * day), ("u", 18 * day + 5), ("v", 0)]
    df = spark.createDataFrame([(i, u, at(s)) for i, (u, s) in enumerate(rows)],
                               "event_id int, uid string, ts timestamp")
    got = logins(df, "ts", ["event_id"]).orderBy("event_id").collect()
    assert [(r.event_id, r.back_ct) for r in got] == [(0, 0), (2, 0), (3, 0), (4, 1), (5, 0)]


def test_newest_per_key_on_a_hot_key(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"), F.col("id").alias("v"))
    got = {r.k: r.v for r in newest_per_key(df, ["k"], ["v"]).collect()}
    expected = {r.k: r.v for r in df.groupBy("k").agg(F.max("v").alias("v")).collect()}
    assert got == expected
    plan = newest_per_key(df, ["k"], ["v"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(spark, how):
    facts = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id") % 100).cast("long").alias("k"))
    dim = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))
    spread = L.spread_join(facts, dim, ["k"], ["id"], how, rows_per_task=50)
    plain = facts.join(dim, ["k"], how)
    columns = ["id", "k", "name"]
    assert sorted(map(str, spread.select(columns).collect())) == sorted(
        map(str, plain.select(columns).collect()))
    hot = L.hot_keys(facts, ["k"], 50)
    assert {r.k: r._parts for r in hot.collect()}[1] > 10


@pytest.mark.parametrize("small", [True, False])
def test_lookup_keeps_rows_whichever_way(spark, small):
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "x"), (4, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "A")], "code string, name string")
    left = L.lookup(facts, dim, ["code"], ["id"], small=small)
    assert sorted((r.id, r.name or "") for r in left.collect()) == [
        (1, "A"), (2, "A"), (3, ""), (4, "")]
    inner = L.lookup(facts, dim, ["code"], ["id"], "inner", small=small)
    assert sorted(r.id for r in inner.collect()) == [1, 2]


def test_cart_additions(spark):
    log = changes(spark, [
        change("cart_info", "insert", {"id": "1", "sku_num": "2"}),
        change("cart_info", "update", {"id": "2", "sku_num": "5"}, {"sku_num": "3"}),
        change("cart_info", "update", {"id": "3", "sku_num": "1"}, {"sku_num": "3"}),
        change("cart_info", "update", {"id": "4", "sku_num": "9"}, {"is_checked": "0"}),
        change("cart_info", "update", {"id": "5", "sku_num": "x"}, {"sku_num": "3"}),
        change("cart_info", "delete", {"id": "6", "sku_num": "9"}, {"sku_num": "3"}),
        change("cart_info", "insert", {"id": "7", "sku_num": "2"}, database="other"),
    ])
    got = trade.cart_additions(log).collect()
    assert sorted((r.id, r.sku_num) for r in got) == [("1", 2), ("2", 2)]


def test_favor_update_of_another_table_stays_out(spark):
    log = changes(spark, [
        change("favor_info", "insert", {"id": "1", "is_cancel": "0"}),
        change("favor_info", "update", {"id": "2", "is_cancel": "0"}, {"is_cancel": "1"}),
        change("favor_info", "update", {"id": "3", "is_cancel": "1"}, {"is_cancel": "0"}),
        change("other", "update", {"id": "4", "is_cancel": "0"}, {"is_cancel": "1"}),
    ])
    assert sorted(r.id for r in actions.favor_add(log).collect()) == ["1", "2"]


def test_order_cancel_needs_a_status_change(spark):
    log = changes(spark, [
        change("order_detail", "insert", {"id": "d1", "order_id": "o1", "source_type": "1"}),
        change("order_detail", "insert", {"id": "d2", "order_id": "o2", "source_type": "1"}),
        change("order_detail", "insert", {"id": "d3", "order_id": "o1", "source_type": "?"}),
        change("order_detail_coupon", "insert", {"order_detail_id": "d1", "coupon_id": "c"}),
        change("order_info", "insert", {"id": "o1", "order_status": "1001"}),
        change("order_info", "update", {"id": "o1", "order_status": "1003"},
               {"order_status": "1001"}, 2),
        change("order_info", "update", {"id": "o2", "order_status": "1003"},
               {"consignee": "x"}, 2),
    ])
    names = spark.createDataFrame([("1", "web")], "dic_code string, dic_name string")
    wide = trade.order_detail_wide(log, names)
    assert sorted((r.order_detail_id, r.type, r.coupon_id) for r in wide.collect()) == [
        ("d1", "insert", "c"), ("d1", "update", "c"), ("d2", "update", None)]
    assert [r.order_detail_id for r in trade.order_cancel(wide).collect()] == ["d1"]
    assert [r.order_detail_id for r in trade.order_add(wide).collect()] == ["d1"]


def test_orders_are_counted_once_per_family(spark):
    dims = {name: F.lit(None).cast("string").alias(name) for name in metrics.PRODUCT_IDS}
    dims["spu_id"], dims["user_id"] = F.lit("s").alias("spu_id"), F.lit("u").alias("user_id")
    rows = spark.createDataFrame(
        [("o1", "k1", "1.10", at(1)), ("o1", "k2", "2.20", at(2)), ("o2", "k1", "3.30", at(9)),
         ("o3", "k9", "4.40", at(10))], "order_id string, sku_id string, a string, event_ts timestamp")
    enriched = rows.select("order_id", "sku_id", "event_ts",
                           F.col("a").cast("decimal(20,4)").alias("amount"), *dims.values())
    got = metrics.spu_order_window(enriched).orderBy("stt").collect()
    assert [(r.stt, r.sku_id, r.order_ct, r.order_amount) for r in got] == [
        ("2024-01-01 00:00:00", "k1", 2, 6.6), ("2024-01-01 00:00:10", "k9", 1, 4.4)]
