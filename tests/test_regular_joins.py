"""Right and full joins on rows where either side has ids that the other one lacks."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from compare import plain

ROWS = {
    "customer": "(VALUES (7::BIGINT, 'a')) t(c_custkey, c_name)",
    # 3 is open, 4 has no line, 5 no finished line; an order without a key meets nothing.
    "orders": "(VALUES (1::BIGINT, 7::BIGINT, 'F', '1-URGENT'), (2, 7, 'O', '5-LOW'), (3, 7, 'P', '2-HIGH'), (4, 7, 'F', '5-LOW'),"
              " (5, 7, 'O', '3-MEDIUM'), (NULL, 7, 'F', '2-HIGH'), (1, 7, 'F', '1-URGENT')) t(o_orderkey, o_custkey, o_orderstatus, o_orderpriority)",
    "lineitem": "(VALUES (1::BIGINT, 'R', 'F'), (1, 'A', 'F'), (2, 'N', 'F'), (2, 'A', 'O'), (3, 'R', 'F'), (5, 'N', 'O'), (6, NULL, 'F'),"
                " (NULL, 'A', 'F')) t(l_orderkey, l_returnflag, l_linestatus)",
}
RIGHT = [(1, "1-URGENT", "A"), (1, "1-URGENT", "A"), (2, "5-LOW", "N"), (3, None, "R"), (6, None, None), (None, None, "A")]
FULL = [
    (1, 1, "1-URGENT", "A"), (1, 1, "1-URGENT", "A"), (2, 2, "5-LOW", "N"), (None, 3, None, "R"), (None, 6, None, None), (None, None, None, "A"),
    (4, None, "5-LOW", None), (5, None, "3-MEDIUM", None), (None, None, "2-HIGH", None),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("sides")
    for name, rows in ROWS.items():
        duckdb.execute(f"COPY (SELECT * FROM {rows}) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return str(path)


def in_order(rows):
    return sorted((tuple(map(plain, row)) for row in rows), key=str)


@pytest.mark.parametrize("name, columns, expected", [
    ("join_right", ["id", "name", "sex"], RIGHT), ("join_full", ["left_id", "right_id", "name", "sex"], FULL),
])
def test_lonely_rows_of_both_sides(spark, folder, name, columns, expected):
    assert in_order(queries()[name](spark, folder).select(*columns).collect()) == in_order(expected)
    con = duckdb.connect()
    for table in ROWS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert in_order(con.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()) == in_order(expected)
