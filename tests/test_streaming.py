"""Streams: restart, late versions, stream joins, configuration changes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.operators import routing
from tidehouse.sources import topics
from tidehouse.plans import trade
from tidehouse.session import ROCKSDB, settings
from tidehouse.streaming import incremental, jobs, sinks, stores, warehouse
from tidehouse.streaming.state import first_of_day_stream

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DAY = 86400


def at(seconds: float) -> dt.datetime:
    return BASE + dt.timedelta(seconds=seconds)


class Feed:
    """A folder to which rows are delivered file by file, and a stream over it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, rows):
        frame = self.spark.createDataFrame(rows, self.schema)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        empty = self.spark.createDataFrame([], self.schema)
        return self.spark.readStream.schema(empty.schema).parquet(self.path)


def run(df, path, check):
    query = sinks.append_rows(df, str(path), str(check))
    query.awaitTermination()
    return query


def test_new_visitor_table_over_two_deliveries(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "n int, mid string, ts timestamp, is_new string")
    out = str(tmp_path / "out")
    write = jobs.new_visitor_writer(out, str(tmp_path / "days"), ["n"])
    deliveries = ([(0, "a", at(0), "1"), (1, "a", at(DAY), "1"), (2, "b", at(0), "0")],
                  [(3, "a", at(5), "1"), (4, "b", at(9), "1"), (5, "c", at(DAY), "1")])
    for rows in deliveries:
        feed.add(rows)
        sinks.each_batch(feed.stream(), write, str(tmp_path / "check")).awaitTermination()
    got = {r.n: r.is_new for r in spark.read.parquet(out).collect()}
    assert got == {0: "1", 1: "0", 2: "0", 3: "1", 4: "0", 5: "1"}
    assert spark.read.parquet(str(tmp_path / "days")).count() == 3


def each(feed, write, check):
    sinks.each_batch(feed.stream(), write, str(check)).awaitTermination()


def test_last_login_over_deliveries(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "uid string, ts timestamp")
    out = str(tmp_path / "out")
    write = jobs.user_logins_writer(out, str(tmp_path / "last"))
    deliveries = ([("u", at(3 * DAY)), ("u", at(0)), ("u", at(1))], [("u", at(11 * DAY)), ("v", at(0)), ("u", at(3 * DAY + 9))])
    for rows in deliveries:
        feed.add(rows)
        each(feed, write, tmp_path / "check")
    got = sorted((r.uid, r.ts.day, r.ts.second, r.back_ct) for r in spark.read.parquet(out).collect())
    assert got == [("u", 1, 0, 0), ("u", 4, 0, 0), ("u", 12, 0, 1), ("v", 1, 0, 0)]


def test_daily_state_is_forgotten_two_days_behind(spark, tmp_path):
    """What Spark's own deduplication still remembers, read from its state: the keys of the last two days."""
    feed = Feed(spark, tmp_path / "in", "mid string, ts timestamp")
    for day in range(5):
        feed.add([(f"m{k}", at(day * DAY + k)) for k in range(3)])
        with settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
            run(first_of_day_stream(feed.stream(), ["mid"]), tmp_path / "out", tmp_path / "check")
    state = spark.read.format("statestore").load(str(tmp_path / "check"))
    assert {r.day.day for r in state.select("key._day").toDF("day").collect()} <= {4, 5}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 15


def test_unique_visitor_over_deliveries_and_a_repeat(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "mid string, ts timestamp, last_page_id string")
    out = str(tmp_path / "out")
    write = jobs.unique_visitors_writer(out)
    for rows in ([("a", at(2), None), ("a", at(1), None)], [("a", at(9000), None), ("a", at(DAY + 1), None), ("b", at(9001), None)]):
        feed.add(rows)
        each(feed, write, tmp_path / "check")
    again = spark.createDataFrame([("a", at(9000), None), ("a", at(DAY + 1), None), ("b", at(9001), None)], feed.schema)
    write(again, 1)
    got = sorted((r.mid, r.ts.day, r.ts.second) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)]


def test_bounce_split_over_deliveries(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "event_id int, mid string, last_page_id string, ts timestamp")
    out = tmp_path / "out"
    deliveries = (
        [(0, "a", None, at(0)), (1, "b", None, at(2))],
        [(2, "a", "home", at(1)), (3, "b", None, at(4))],  # within the two seconds of grace
        [(4, "z", "home", at(14)), (5, "c", None, at(13))],  # settles b's first entry
        [(6, "c", "home", at(11)), (7, "c", "home", at(14))],  # one too late, one in time
        [(8, "z", "home", at(100))],
        [(9, "z", "home", at(200))],
    )
    write = jobs.user_jumps_writer(str(out), str(tmp_path / "pending"), ["event_id"])
    seen = []
    for rows in deliveries:
        feed.add(rows)
        check = str(tmp_path / "check")
        sinks.each_batch(feed.stream(), write, check).awaitTermination()
        seen.append(sorted(r.event_id for r in spark.read.parquet(str(out)).collect()))
    assert seen == [[], [], [1], [1], [1, 3], [1, 3]]


def test_order_detail_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", S.CHANGE)
    names = spark.createDataFrame([("1", "web")], "dic_code string, dic_name string")

    def change(table, kind, ts, data, old=None):
        return (S.DATABASE, table, kind, ts, data, old)

    start = int(BASE.timestamp())
    rows = [
        change("order_detail", "insert", start,
               {"id": "d1", "order_id": "o1", "source_type": "1", "sku_num": "2",
                "order_price": "3.50"}),
        change("order_detail", "insert", start,
               {"id": "d2", "order_id": "o2", "source_type": "1"}),
        change("order_detail", "insert", start,
               {"id": "d3", "order_id": "o1", "source_type": "unknown"}),
        change("order_detail_coupon", "insert", start + 5,
               {"order_detail_id": "d1", "coupon_id": "c1"}),
        change("order_info", "insert", start + 1, {"id": "o1", "order_status": "1001"}),
        change("order_info", "update", start + 2 * DAY, {"id": "o1", "order_status": "1002"},
               {"order_status": "1001"}),
        change("order_info", "insert", start + 9 * DAY, {"id": "o2", "order_status": "1001"}),
    ]
    # Far later records of every kind move the watermark on.
    later = start + 40 * DAY
    rows2 = [
        change("order_detail", "insert", later, {"id": "x", "order_id": "x", "source_type": "1"}),
        change("order_detail_activity", "insert", later, {"order_detail_id": "x"}),
        change("order_detail_coupon", "insert", later, {"order_detail_id": "x"}),
        change("order_info", "insert", later, {"id": "y"}),
    ]
    out = tmp_path / "out"
    for delivery in (rows, rows2):
        feed.add(delivery)
        run(jobs.order_detail_stream(feed.stream(), names), out, tmp_path / "check")
    got = spark.read.parquet(str(out)).filter("order_detail_id <> 'x'").collect()
    assert sorted((r.order_detail_id, r.type, r.coupon_id, r.activity_id, r.split_original_amount)
                  for r in got) == [("d1", "insert", "c1", None, "7.0000"),
                                    ("d1", "update", "c1", None, "7.0000")]


def test_newest_after_quiet(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "id string, ts timestamp, v int")
    feed.add([("a", at(0), 1), ("a", at(1), 2), ("a", at(10), 3), ("z", at(100), 0)])
    newest = jobs.newest_after_quiet_stream(feed.stream(), "id", "ts", ["v"])
    run(newest, tmp_path / "out", tmp_path / "check")
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.id, r.v) for r in got) == [("a", 2), ("a", 3)]


def test_upsert_keeps_newest_over_batches_and_repeats(spark, tmp_path):
    path = str(tmp_path / "table")
    write = sinks.upsert_writer(path, ["id"], ["ts"])

    def batch(rows):
        return spark.createDataFrame(rows, "id string, ts int, name string, gone boolean")

    write(batch([("a", 1, "x", False), ("a", 2, "y", False), ("b", 5, "x", False)]), 0)
    write(batch([("a", 1, "old", False), ("b", 6, None, True), ("c", 1, "z", False)]), 1)
    write(batch([("a", 1, "old", False), ("b", 6, None, True), ("c", 1, "z", False)]), 1)
    write(batch([("c", 1, "tie", False)]), 2)
    latest = sinks.read_latest(spark, path, ["id"], ["ts"], deleted="gone")
    expected = [("a", "y"), ("c", "tie")]
    assert sorted((r.id, r.name) for r in latest.collect()) == expected
    compacted = str(tmp_path / "compacted")
    sinks.compact_latest(spark, path, compacted, ["id"], ["ts"])
    assert spark.read.parquet(compacted).count() == 3
    again = sinks.read_latest(spark, compacted, ["id"], ["ts"], deleted="gone")
    assert sorted((r.id, r.name) for r in again.collect()) == expected


def test_dimension_writer_reads_the_configuration_anew(spark, tmp_path):
    rows = [("shop", "part", "insert", 1, {"id": "1", "name": "n", "x": "y"}, None),
            ("shop", "brand", "insert", 1, {"id": "9", "name": "b"}, None),
            ("shop", "part", "delete", 2, {"id": "1"}, None)]
    batch = spark.createDataFrame(rows, S.CHANGE)
    configs = [[("part", "dim_part", "id,name", None, None)],
               [("part", "dim_part", "id", None, None), ("brand", "dim_brand", "id,name", "", None)]]
    lines = [F.to_json(F.struct(F.struct(*S.CONFIG_ROW.names).alias("after"),
                                F.lit(1).alias("ts_ms"))).alias("value")]

    def config():
        raw = spark.createDataFrame(configs.pop(0), S.CONFIG_ROW).select(*lines)
        return routing.latest_config(topics.config_records(raw))

    write = sinks.dimension_writer(str(tmp_path / "dims"), config)
    write(batch, 0)
    write(batch, 1)
    got = spark.read.parquet(str(tmp_path / "dims")).orderBy("batch", "sink_table").collect()
    assert [(r.batch, r.sink_table, r.pk, r.data) for r in got] == [
        (0, "dim_part", "1", {"id": "1", "name": "n"}),
        (1, "dim_brand", "9", {"id": "9", "name": "b"}),
        (1, "dim_part", "1", {"id": "1"}),
    ]


def test_window_writer_orders_and_skips_columns(spark, tmp_path):
    batch = spark.createDataFrame([(3, "a", "b", "secret")], "ct int, stt string, edt string, t string")
    sinks.window_writer(["stt", "edt", "ct", "t"], str(tmp_path / "w"), transient=["t"])(batch, 0)
    assert spark.read.parquet(str(tmp_path / "w/batch=0")).columns == ["stt", "edt", "ct"]


def test_topic_round_trip(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "id int, name string")
    feed.add([(1, "a"), (2, None)])
    sinks.append_topic(feed.stream(), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    read = topics.read_json_topic(spark, str(tmp_path / "t"), feed.stream().schema, streaming=False)
    assert sorted((r.id, r.name) for r in read.collect()) == [(1, "a"), (2, None)]


def order_change(table, kind, ts, data, old=None):
    return (S.DATABASE, table, kind, ts, data, old)


def test_late_order_rows_correct_the_facts(spark, tmp_path):
    """A line and its header five seconds and one day late, a coupon after its line, and a repeat of the last batch."""
    names = spark.createDataFrame([("1", "web")], "dic_code string, dic_name string")
    start = int(BASE.timestamp())

    def line(key, order, ts):
        return order_change("order_detail", "insert", ts, {"id": key, "order_id": order, "source_type": "1", "sku_num": "1", "order_price": "2.00"})

    def header(order, ts):
        return order_change("order_info", "insert", ts, {"id": order, "order_status": "1001"})

    batches = [
        [line("d1", "o1", start + 10), header("o1", start + 10)],
        [line("d2", "o2", start + 5), header("o2", start + 5), line("d3", "o3", start + 2 * DAY)],
        [header("o3", start + DAY), order_change("order_detail_coupon", "insert", start + 12, {"order_id": "o1", "order_detail_id": "d1", "coupon_id": "c"})],
        [order_change("order_info", "update", start + 2 * DAY + k, {"id": "o1", "order_status": "1002"}, {"order_status": "1001"}) for k in range(2)],
    ]
    out = str(tmp_path / "out")
    write = incremental.order_facts_writer(out, str(tmp_path / "store"), lambda log: trade.order_detail_wide(log, names), every=2)
    for number, rows in [*enumerate(batches), (3, batches[3])]:
        write(incremental.with_order(spark.createDataFrame(rows, S.CHANGE)), number)
    got = incremental.current(spark, out, ["order_id"]).collect()
    table = trade.order_detail_wide(spark.createDataFrame([r for b in batches for r in b], S.CHANGE), names).collect()
    assert sorted(map(str, got)) == sorted(map(str, table)) and len(got) == 5
    assert {(r.order_detail_id, r.coupon_id) for r in got} == {("d1", "c"), ("d2", None), ("d3", None)}


@pytest.mark.parametrize("second_day", [3, 6])
def test_refunds_of_an_order_days_apart(spark, tmp_path, second_day):
    """The first refund stays after its records have gone, and an order touched within the retention is kept whole."""
    names = spark.createDataFrame([], S.DICTIONARY)
    start = int(BASE.timestamp())

    def refund(key, order, day):
        return order_change("order_refund_info", "insert", start + day * DAY, {"id": key, "order_id": order, "sku_id": key, "refund_type": "1"})

    days = [[refund("r1", "o1", 0)], [refund("x", "o2", 4)], [refund("r2", "o1", second_day)], [refund("y", "o3", 6)], [refund("r3", "o1", 7)]]
    out = str(tmp_path / "order_refund")
    write = incremental.order_facts_writer(out, str(tmp_path / "store"), lambda log: trade.order_refund_wide(log, names), every=2)
    for number, rows in enumerate(days):
        write(incremental.with_order(spark.createDataFrame(rows, S.CHANGE)), number)
    assert sorted(r.id for r in warehouse.latest(spark, "order_refund", str(tmp_path)).collect()) == ["r1", "r2", "r3", "x", "y"]


def test_stores_stay_small(spark, tmp_path):
    path = tmp_path / "store"
    store = stores.keyed_store(str(path), ["id"], ["ts"], every=4)
    for number in range(21):
        rows = spark.createDataFrame([(number % 3, number, f"v{number}"), (100 + number, number, "x")], "id int, ts int, v string")
        store.append(rows, number)
    assert len([p for p in path.iterdir() if p.is_dir()]) <= 2 * 4 + 2
    got = {r.id: r.v for r in sinks.read_latest(spark, str(path), ["id"], ["ts"]).collect()}
    assert got == {0: "v18", 1: "v19", 2: "v20", **{100 + k: "x" for k in range(21)}}


def test_the_last_of_eight_updates_in_one_second(spark, tmp_path):
    rows = [order_change("order_info", "update", 7, {"id": "o", "order_status": str(status)}, {"order_status": "0"})
            for status in (1003, 1000, 1007, 1001, 1006, 1002, 1005, 1004)]
    line = F.to_json(F.struct(*S.CHANGE.names)).alias("value")
    for part in (rows[:5], rows[5:]):
        spark.createDataFrame(part, S.CHANGE).select(line).coalesce(1).write.mode("append").parquet(str(tmp_path / "topic"))
    log = topics.change_records(topics.read_topic(spark, str(tmp_path / "topic"), streaming=False, sequence=True))
    newest = trade.newest_headers(trade.order_headers(log.repartition(3)))
    assert [r.order_status for r in newest.collect()] == ["1004"]


def test_dimension_view_over_two_batches(spark, tmp_path):
    config = spark.createDataFrame([("part", "dim_part", "id,name", "id", None)], S.CONFIG_ROW)
    write = sinks.dimension_writer(str(tmp_path / "dims"), lambda: config)
    for number, (ts, name) in enumerate([(2, "new"), (1, "late")]):
        rows = [("shop", "part", "insert", ts, {"id": "1", "name": name}, None), ("shop", "part", "insert", 1, {"id": f"n{number}", "name": "x"}, None)]
        write(spark.createDataFrame(rows, S.CHANGE), number)
    got = sinks.read_dimension(spark, str(tmp_path / "dims"), "dim_part", config)
    assert got.columns == ["id", "name"]
    assert sorted((r.id, r.name) for r in got.collect()) == [("1", "new"), ("n0", "x"), ("n1", "x")]
