"""Streams over tables that lie in several files: shuffled in one micro-batch, and a visitor with a third of all rows."""

from __future__ import annotations

import duckdb
import pytest
from compare import TABLES, compare

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
SPLIT = {"events": 6, "orders": 3, "lineitem": 4}
HOT = {"events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)"}
NAMES = [
    "stream_unique_visitor", "stream_unique_visitor_first", "stream_home_detail", "stream_user_login",
    "stream_page_view_window", "stream_fix_is_new", "stream_cart_first", "stream_user_jump",
    "stream_order_detail", "stream_pay_detail", "stream_refund_pay", "stream_trade_spu_window",
    "stream_cart_uu_window", "sink_upsert_latest",
]


def split_tables(folder, columns):
    con = duckdb.connect()
    whole = folder / "whole"
    whole.mkdir()
    for name in TABLES:
        source = f"(SELECT {columns.get(name, '*')} FROM read_parquet('{SF}/{name}.parquet'))"
        con.execute(f"COPY {source} TO '{whole}/{name}.parquet' (FORMAT parquet)")
        parts = folder / f"{name}.parquet"
        parts.mkdir()
        n = SPLIT.get(name, 1)
        for k in range(n):
            rows = f"(SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER () AS n FROM {source}) WHERE n % {n} = {k} ORDER BY hash(n))"
            con.execute(f"COPY {rows} TO '{parts}/part-{k}.parquet' (FORMAT parquet)")
    return str(folder), str(whole)


@pytest.fixture(scope="module")
def split(tmp_path_factory):
    return split_tables(tmp_path_factory.mktemp("split"), {})


@pytest.fixture(scope="module")
def split_hot(tmp_path_factory):
    return split_tables(tmp_path_factory.mktemp("split-hot"), HOT)


@pytest.mark.parametrize("name", NAMES)
def test_shuffled_files(spark, split, name):
    folder, whole = split
    assert compare(queries()[name](spark, folder), whole, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["stream_unique_visitor_first", "stream_user_login", "stream_fix_is_new", "stream_home_detail"])
def test_shuffled_files_with_a_busy_visitor(spark, split_hot, name):
    folder, whole = split_hot
    assert compare(queries()[name](spark, folder), whole, oracle_sql()[name]) == []
