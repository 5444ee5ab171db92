"""Queries on tables in which one user, order, part or code holds a third of all rows.

The limit for cutting a key is lowered, so that the hot keys are really cut.
"""

from __future__ import annotations

import duckdb
import pytest
from compare import TABLES, compare

from __spark_entry__ import oracle_sql, queries
from tidehouse.operators import lookup

SF = "/root/testdata/sf0.001"
SKEWED = {
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN '3-MEDIUM' ELSE o_orderpriority END "
              "AS o_orderpriority)",
    "lineitem": "* REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN l_suppkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)",
}
NAMES = [
    "fix_is_new", "unique_visitor", "user_jump", "interval_join", "page_view_window",
    "home_detail_uv", "user_login", "cart_uu_window", "latest_per_key", "order_detail_inner",
    "order_detail_wide", "pay_detail_wide", "order_refund_wide", "refund_pay_wide",
    "dim_chain_enrich", "trade_spu_window", "join_inner", "join_left", "join_right", "join_full",
    "lookup_left", "stream_unique_visitor", "stream_user_jump", "stream_fix_is_new_table",
    "stream_fix_is_new", "stream_unique_visitor_first", "stream_home_detail", "stream_user_login", "stream_cart_first",
    "stream_page_view_window", "stream_interval_join", "stream_order_detail", "stream_pay_detail", "stream_order_refund",
    "stream_refund_pay", "fact_join_left", "fact_join_full", "stream_full_join", "stream_right_join",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        columns = SKEWED.get(name, "*")
        con.execute(
            f"COPY (SELECT {columns} FROM read_parquet('{SF}/{name}.parquet')) "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 50)
    assert compare(queries()[name](spark, skewed), skewed, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["lookup_left", "lookup_inner", "dim_chain_enrich"])
def test_dimensions_too_large_to_broadcast(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(lookup, "is_small", lambda df, max_rows=0: False)
    monkeypatch.setattr("tidehouse.queries.is_small", lambda df: False)
    assert compare(queries()[name](spark, skewed), skewed, oracle_sql()[name]) == []
