"""Order lines of large tables, written part by part before their last shuffle."""

from __future__ import annotations

from collections import Counter

import pytest

from tidehouse import schemas as S
from tidehouse.operators import parts
from tidehouse.plans import trade

SOURCE = {"source_type": "1", "sku_num": "2", "order_price": "1.50", "sku_id": "s", "split_total_amount": "3.00"}


def record(table, data, ts=0, kind="insert"):
    return (S.DATABASE, table, kind, ts, data, {"order_status": "0", "payment_status": "1601"} if kind == "update" else None)


@pytest.fixture(scope="module")
def changes(spark, tmp_path_factory):
    """Lines without an id, lines that come twice or move to another order, offers of another order than their line's."""
    ids = [None, *(f"d{k}" for k in range(30))]
    rows = [record("order_detail", {"id": i, "order_id": f"o{k % 7}", **SOURCE}, k % 3) for k, i in enumerate(ids * 2)]
    rows += [record("order_detail_activity", {"order_detail_id": i, "order_id": "o9", "activity_id": str(k)}, k) for k, i in enumerate(ids[::2] * 2)]
    rows += [record("order_detail_coupon", {"order_detail_id": i, "coupon_id": str(k)}, k) for k, i in enumerate(ids[::3])]
    rows += [record("order_info", {"id": f"o{k}", "order_status": "1003"}, 5, kind) for k in range(9) for kind in ("insert", "update")]
    rows += [record("payment_info", {"order_id": f"o{k}", "payment_type": "1", "payment_status": "1602"}, 6, "update") for k in range(4)]
    path = str(tmp_path_factory.mktemp("changes") / "log")
    spark.createDataFrame(rows, S.CHANGE).write.parquet(path)
    return spark.read.parquet(path)


def rows_of(df):
    return Counter(str(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("compute", [trade.order_detail_wide, trade.pay_detail_of])
def test_laid_lines_give_the_same_rows(spark, changes, monkeypatch, compute):
    monkeypatch.setattr(parts, "PART_BYTES", 1)
    names = spark.createDataFrame([("1", "web")], "dic_code string, dic_name string")
    laid, plain = compute(changes, names, laid=True), compute(changes, names)
    assert any("/order-lines-" in f for f in laid.inputFiles()) and not any("/order-lines-" in f for f in plain.inputFiles())
    assert rows_of(laid) == rows_of(plain) and plain.count()


def test_small_tables_are_not_written(spark, changes):
    names = spark.createDataFrame([("1", "web")], "dic_code string, dic_name string")
    assert not any("/order-lines-" in f for f in trade.order_detail_wide(changes, names, laid=True).inputFiles())
