"""State in buckets, change logs with retractions, committed hops, windows of parts, regular joins, deadlines."""

from __future__ import annotations

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidehouse import schemas as S
from tidehouse.operators import lookup, patterns, routing
from tidehouse.plans import metrics, trade
from tidehouse.session import settings
from tidehouse.streaming import buckets, changelog, deadlines, hops, incremental, joins, sinks, tables
from tidehouse.streaming.buckets import BucketStore

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
START, DAY = int(BASE.timestamp()), 86400


def folder_bytes(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def scanned(df, metric):
    """Sum of a metric over the file scans of a plan that has run, such as the bytes or files that partition pruning left."""
    spark = df.sparkSession
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        df = df.select("*")
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        leaves = execution.executedPlan().collectLeaves()
        found = [leaves.apply(k).metrics().get(metric) for k in range(leaves.size())]
    return sum(m.get().value() for m in found if m.isDefined())


# --- buckets -------------------------------------------------------------------------------------


def test_runs_cover_all_batches_and_stay_few():
    store = BucketStore("x", ["k"], every=4)
    for n in range(300):
        runs = store.cover(n)
        assert [b for _, first, last in runs for b in range(first, last + 1)] == list(range(n))
        assert len(runs) <= 3 * 5


def test_newest_rows_over_many_batches_and_repeats(spark, tmp_path):
    store = BucketStore(str(tmp_path / "s"), ["k"], buckets.newest(["k"], ["v"]), every=3, buckets=5)
    rng, plain = random.Random(1), {}
    for n in range(13):
        rows = [(rng.choice([None, *range(12)]), rng.randrange(1000), {"a": str(n)}) for _ in range(6)]
        df = spark.createDataFrame(rows, "k int, v int, m map<string,string>")
        keys = {r[0] for r in rows}
        found = store.touched(df, n)
        got = {} if found is None else {r.k: r.v for r in lookup_newest(found)}
        assert got == {k: v for k, v in plain.items() if k in keys}
        store.append(df, n)
        if n % 4 == 1:  # the batch again, as after a failure
            assert {r.k: r.v for r in lookup_newest(store.touched(df, n))} == got if found is not None else True
            store.append(df, n)
        for k, v, _ in rows:
            plain[k] = max(v, plain.get(k, -1))
    assert {r.k: r.v for r in lookup_newest(store.before(spark))} == plain
    assert len([p for p in (tmp_path / "s").iterdir() if p.is_dir()]) <= 2 * 3 * 2 + 2


def lookup_newest(df):
    return buckets.newest(["k"], ["v"])(df).collect()


def test_a_small_batch_opens_few_buckets_of_a_large_store(spark, tmp_path):
    store = BucketStore(str(tmp_path / "s"), ["k"])
    big = spark.range(100_000).select(F.concat(F.lit("key "), "id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for n in range(8):
        store.append(big.filter(F.col("id") % 8 == n), n)
    ten = spark.createDataFrame([(f"key {k * 7919}",) for k in range(10)], "k string")
    found = store.touched(ten, 8)
    assert {r.k for r in found.collect()} == {f"key {k * 7919}" for k in range(10)}
    assert 0 < scanned(found, "filesSize") < 0.1 * folder_bytes(tmp_path / "s")
    # Inside the files, the sort by hash leaves a part of the rows.
    assert scanned(found, "numOutputRows") < 0.1 * 100_000
    absent = spark.createDataFrame([("no such key",)], "k string")
    assert scanned(store.touched(absent, 8), "filesSize") < 0.03 * folder_bytes(tmp_path / "s")


def test_expired_rows_go(spark, tmp_path):
    store = BucketStore(str(tmp_path / "s"), ["k"], buckets.merged_sums(["k", "t"], ["n"]), every=2, time="t", keep_s=10)
    for n in range(17):
        store.append(spark.createDataFrame([("a", n * 6, 1), ("a", n * 6, 1)], "k string, t long, n long"), n)
    batch = spark.createDataFrame([("a",)], "k string")
    rows = store.touched(batch, 17).groupBy("t").agg(F.sum("n").alias("n")).collect()
    assert {(r.t, r.n) for r in rows} == {(90, 2), (96, 2)}
    assert folder_rows(spark, tmp_path / "s") <= 8


def folder_rows(spark, path):
    return sum(spark.read.parquet(str(run)).count() for run in path.iterdir() if run.is_dir())


# --- change logs -----------------------------------------------------------------------------------


def table_rows(df):
    return Counter(str(r) for r in df.select(sorted(df.columns)).collect())


def test_logs_replay_whatever_is_compacted(spark):
    rng = random.Random(2)
    schema = "k int, v string, m map<string,string>"

    def some():
        rows = [(rng.randrange(3), rng.choice(["x", None]), rng.choice([None, {"a": "1", "b": "2"}, {"b": "2", "a": "1"}])) for _ in range(8)]
        return spark.createDataFrame(rows, schema)

    old, log = None, None
    for n in range(4):
        new = some()
        change = changelog.difference(new, old).withColumn("_batch", F.lit(n).cast("long"))
        log = change if log is None else changelog.compacted(log).select(*change.columns).unionByName(change)
        old = new
        assert table_rows(changelog.replayed(log)) == table_rows(new)
    assert not changelog.difference(old, old).count()


def test_replaced_rows_are_updates(spark):
    schema = "id int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], schema)
    log = {tuple(r) for r in changelog.difference(new, old, ["id"]).collect()}
    assert log == {(2, "b", "-U"), (2, "x", "+U"), (3, "c", "-D"), (4, "d", "+I")}


def line(key, order, day=0.0, amount="2.00"):
    data = {"id": key, "order_id": order, "source_type": "1", "sku_num": "1", "order_price": amount, "sku_id": "s", "split_total_amount": amount,
            "create_time": "2024-01-01 00:00:03"}
    return (S.DATABASE, "order_detail", "insert", START + int(day * DAY), data, None)


def header(order, day=0.0, kind="insert", status="1001"):
    old = {"order_status": "0"} if kind == "update" else None
    return (S.DATABASE, "order_info", kind, START + int(day * DAY), {"id": order, "order_status": status, "user_id": "u"}, old)


def payment(order, day):
    data = {"order_id": order, "user_id": "u", "payment_type": "1", "payment_status": "1602", "callback_time": "t"}
    return (S.DATABASE, "payment_info", "update", START + int(day * DAY), data, {"payment_status": "1601"})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_log_without_rows_taken_back_is_not_shuffled(spark, tmp_path):
    rows = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (1, {"b": "2", "a": "1"}), (2, None), (None, {})], "id int, m map<string,string>")
    log = changelog.difference(rows, None)
    assert "Exchange" not in plan_of(log) and {r.kind for r in log.collect()} == {"+I"}
    log.write.parquet(str(tmp_path / "log"))
    table = changelog.table(spark, str(tmp_path / "log"))
    assert "Exchange" not in plan_of(table) and table_rows(table) == table_rows(rows)


@pytest.mark.parametrize("few", [0, 100])
def test_a_standing_log_is_the_replayed_one(spark, monkeypatch, few):
    monkeypatch.setattr(changelog, "FEW_GONE", few)
    rng = random.Random(3)
    maps = [None, {"a": "1", "b": "2"}, {"b": "2", "a": "1"}, {}]
    log = [(rng.randrange(4), rng.choice(maps), "+I") for _ in range(60)]
    log += [(k, m, rng.choice(["-D", "-U"])) for k, m, _ in rng.sample(log, 25)]
    df = spark.createDataFrame(log, "id int, m map<string,string>, kind string")
    assert table_rows(changelog.standing(df)) == table_rows(changelog.replayed(df)) and changelog.standing(df).count() == 35


@pytest.mark.parametrize("moved", [False, True])
def test_a_large_batch_goes_by_groups_and_is_held_by_its_store(spark, tmp_path, monkeypatch, moved):
    """As in one piece, also where a line moves to another order; no copy of the batch is persisted."""
    monkeypatch.setattr(changelog, "GROUP_BYTES", 1)
    dictionary, out, calls, held = names(spark), str(tmp_path / "facts"), [], []

    def compute(log):
        calls.append(log.count())
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return trade.order_detail_wide(log, dictionary)

    write = incremental.order_facts_writer(out, str(tmp_path / "store"), compute, every=2, buckets=4)
    first = [r for k in range(12) for r in (line(f"d{k}", f"o{k}"), line(f"e{k}", f"o{k}"), header(f"o{k}"))]
    second = [r for k in range(6, 15) for r in (line(f"d{k}", f"o{k}", 1, "7.00"), header(f"o{k}", 1, "update"))]
    second += [line("d6", f"o{k}", 1 + k) for k in range(7, 15)] if moved else []
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for n, rows in enumerate((first, second)):
        write(incremental.with_order(spark.createDataFrame(rows, S.CHANGE)), n)
        assert len(calls) == (1 if moved and n else 4) and set(held) == {before}
        calls.clear()
    seen = first + second
    wide = trade.order_detail_wide(spark.createDataFrame(seen, S.CHANGE), dictionary)
    assert table_rows(incremental.current(spark, out, ["order_id"])) == table_rows(wide)
    assert table_rows(changelog.standing(incremental.order_results(str(tmp_path / "store"), every=2, buckets=4).before(spark))) == table_rows(wide)


NAMES = [("1", "web")]


def names(spark):
    return spark.createDataFrame(NAMES, "dic_code string, dic_name string")


@pytest.mark.parametrize("paid_day", [6])
def test_a_late_payment_meets_its_whole_order(spark, tmp_path, paid_day):
    """The order on day 0, others in between so that state is merged several times, then the payment, in the job's own form."""
    out, dictionary = str(tmp_path / "pay"), names(spark)
    write = incremental.order_facts_writer(out, str(tmp_path / "store"), lambda log: trade.pay_detail_of(log, dictionary), ("order_detail_id",), every=2)
    days = [[line("d1", "o1"), line("d2", "o1"), header("o1")]]
    days += [[line(f"x{k}", f"p{k}", k + 1), header(f"p{k}", k + 1), payment(f"p{k}", k + 1)] for k in range(5)]
    days += [[payment("o1", paid_day)], [header("o1", paid_day, "update", "1002")], [line("d3", "o1", paid_day)]]
    for n, rows in enumerate(days):
        write(incremental.with_order(spark.createDataFrame(rows, S.CHANGE)), n)
    table = trade.pay_detail_of(spark.createDataFrame([r for d in days for r in d], S.CHANGE), dictionary)
    assert table_rows(incremental.current(spark, out, ["order_id"])) == table_rows(table)
    assert {r.order_detail_id for r in table.collect()} == {"d1", "d2", "d3", *(f"x{k}" for k in range(5))}


def test_a_window_behind_a_change_log_subtracts(spark, tmp_path):
    """Lines come, are replaced by newer versions and meet new headers; after each batch the window is the table's."""
    dictionary, out, windows = names(spark), str(tmp_path / "facts"), str(tmp_path / "windows")
    sku = spark.createDataFrame([("s", "p", "t", "c")], "sku_id string, spu_id string, trademark_id string, category3_id string")
    from tidehouse.plans import dimensions
    from tidehouse.streaming import warehouse

    facts = incremental.order_facts_writer(out, str(tmp_path / "store"), lambda log: trade.order_detail_wide(log, dictionary), every=2)
    rule = warehouse.JOBS["trade_window"].rule({"sku": lambda: sku})
    count = incremental.window_writer(windows, str(tmp_path / "parts"), "event_ts", rule, every=2)
    batches = [
        [line("d1", "o1"), line("d2", "o2")], [header("o1")], [line("d1", "o1", 1, "5.00"), header("o2")],
        [line("d3", "o1", 1)], [header("o2", 1, "update")], [line("d2", "o2", 2, "9.00")],
    ]
    seen, kinds = [], set()
    for n, rows in enumerate(batches):
        seen += rows
        facts(incremental.with_order(spark.createDataFrame(rows, S.CHANGE)), n)
        log = spark.read.parquet(sinks.batch_folder(out, n))
        kinds |= {r.kind for r in log.select("kind").collect()}
        count(warehouse.JOBS["trade_window"].select(log), n)
        wide = trade.order_add(trade.order_detail_wide(spark.createDataFrame(seen, S.CHANGE), dictionary))
        lines = dimensions.with_product(metrics.order_lines_for_window(wide), sku, ["order_id"])
        assert table_rows(incremental.windows_now(spark, windows, rule)) == table_rows(metrics.spu_order_window(lines))
    assert kinds == {"+I", "-D"}


def test_a_window_without_rows_left_goes(spark, tmp_path):
    rule = incremental.additive(lambda rows: metrics.tumble(rows, {"n": F.count(F.lit(1))}, ["k"]), ["n"], ["k"], signed=True)
    write = incremental.window_writer(str(tmp_path / "w"), str(tmp_path / "p"), "ts", rule)
    schema = "k string, ts timestamp, kind string"
    write(spark.createDataFrame([("a", BASE, "+I"), ("b", BASE, "+I"), ("b", BASE, "+I")], schema), 0)
    write(spark.createDataFrame([("a", BASE, "-D"), ("b", BASE, "-U")], schema), 1)
    assert {(r.k, r.n) for r in incremental.windows_now(spark, str(tmp_path / "w"), rule).collect()} == {("b", 1)}


# --- windows of parts ----------------------------------------------------------------------------


def test_window_state_stays_flat_over_sixty_batches(spark, tmp_path):
    """Every batch brings ten minutes of rows; state, and what a batch reads, does not grow with the history."""
    rule = incremental.additive(metrics.page_view_window, metrics.TRAFFIC_MEASURES, metrics.TRAFFIC_DIMS)
    late = []
    write = incremental.window_writer(
        str(tmp_path / "w"), str(tmp_path / "p"), "ts", rule, lateness_s=1200, every=4, counted=lambda n, count: late.append(count)
    )
    store = BucketStore(str(tmp_path / "p"), rule.keys, every=4, time="_second", keep_s=1200)
    sizes = []

    def rows(first, last):
        k = F.col("id") % 40
        second = F.floor(F.col("id") / 40) * 600 + k * 15 - F.when(k == 7, 1100).otherwise(0) + START
        page = spark.range(first * 40, last * 40).select(
            F.concat(F.lit("v"), F.col("id") % 3).alias("vc"), F.lit("c").alias("ch"), F.lit("r").alias("ar"), F.lit("1").alias("is_new"),
            F.lit(None).cast("string").alias("last_page_id"), F.col("id").alias("during_time"), F.timestamp_seconds(second).alias("ts"),
        )
        return metrics._traffic_rows(page, pv_ct=F.lit(1), dur_sum=F.col("during_time"))

    with settings(spark, {"spark.sql.shuffle.partitions": "1"}):
        for n in range(60):
            write(rows(n, n + 1).coalesce(1), n)
            if n % 4 == 1:
                found = store.before(spark, n + 1)
                sizes.append((scanned(found, "filesSize"), found.count()))
    # The same state is in reach early and late; merged runs add the little that is not yet left out.
    early, end = sizes[2:6], sizes[-4:]
    assert max(c for _, c in end) <= 1.1 * max(c for _, c in early)
    assert max(b for b, _ in end) <= 1.5 * max(b for b, _ in early)
    assert late and not any(late)
    assert table_rows(incremental.windows_now(spark, str(tmp_path / "w"), rule)) == table_rows(metrics.page_view_window(rows(0, 60)))


def test_rows_that_come_too_late_are_set_apart_and_counted(spark, tmp_path):
    rule = incremental.additive(lambda rows: metrics.tumble(rows, {"n": F.count(F.lit(1))}), ["n"])
    late, out = {}, str(tmp_path / "w")
    write = incremental.window_writer(out, str(tmp_path / "p"), "ts", rule, lateness_s=20, counted=late.__setitem__)

    def batch(*seconds):
        return spark.createDataFrame([(BASE + dt.timedelta(seconds=s),) for s in seconds], "ts timestamp")

    write(batch(0, 5, 61), 0)
    write(batch(39, 40, 41, 7), 1)  # the newest window began at 60, so windows from 40 on are open
    write(batch(39, 40, 41, 7), 1)
    got = {r.stt[-5:]: r.n for r in incremental.windows_now(spark, out, rule).collect()}
    assert got == {"00:00": 2, "01:00": 1, "00:40": 2} and late == {1: 2}
    kept = spark.read.parquet(incremental.late_folder(out)).collect()
    assert sorted(r.ts.second for r in kept) == [7, 39]


# --- hops ------------------------------------------------------------------------------------------


def test_a_repeated_batch_reaches_the_next_hop_once(spark, tmp_path):
    """Batch 0 is run again after its commit, and once more half done before one; the next job gets each row once."""
    root, schema = str(tmp_path), "id int, v string"

    def rows(*ids):
        return spark.createDataFrame([(k, f"v{k}") for k in ids], schema)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(sinks.batch_folder(f"{root}/first", batch_id))

    commit = hops.committing(spark, root, "first", write)
    taken = []
    step = lambda first, extra, n: taken.append((n, sorted(r.id for r in first.collect()), extra.count()))

    def follow():
        extra = spark.readStream.schema(schema).parquet(str(tmp_path / "extra"))
        streams = [hops.follow(spark, root, "first"), extra]
        split = hops.each_input(spark, root, ["first", "extra"], streams, step)
        sinks.each_batch(hops.merged(streams), split, str(tmp_path / "check")).awaitTermination()

    rows(1).write.parquet(str(tmp_path / "extra"))
    commit(rows(1, 2), 0)
    commit(rows(1, 2), 0)
    follow()
    commit(rows(1, 2), 0)
    write(rows(3), 1)  # lost before its commit, and run again
    follow()
    commit(rows(3), 1)
    commit(rows(4), 2)
    follow()
    assert taken == [(0, [1, 2], 1), (1, [3, 4], 0)]
    assert sorted((r.batch, r.id) for r in hops.table(spark, root, "first").collect()) == [(0, 1), (0, 2), (1, 3), (2, 4)]
    # What all followers have taken may go; a batch run again after that still does nothing, and later ones go on.
    hops.trim(spark, root, "first", 2)
    commit(rows(1, 2), 0)
    assert [r.id for r in hops.table(spark, root, "first").collect()] == [4]
    commit(rows(5), 3)
    follow()
    assert taken[2:] == [(2, [5], 0)]


# --- regular joins ---------------------------------------------------------------------------------


def deliver(spark, writer, left, right, n):
    a = spark.createDataFrame(left, "k int, a string, at long")
    b = spark.createDataFrame(right, "k int, b string, bt long")
    writer(joins.two_sides(a, b), n)


def plain_join(left, right, how):
    out = Counter()
    for k, a, at in left:
        found = [r for r in right if k is not None and r[0] == k]
        for _, b, bt in found:
            out[(k, a, at, b, bt)] += 1
        if not found and how in ("left", "full"):
            out[(k, a, at, None, None)] += 1
    for k, b, bt in right:
        if how in ("right", "full") and (k is None or not any(r[0] == k for r in left)):
            out[(k, None, None, b, bt)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_regular_join_after_every_batch(spark, tmp_path, monkeypatch, how):
    """Six deliveries in any order, a hot key, null keys, equal rows and a repeat."""
    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 5)
    out = str(tmp_path / "out")
    write = joins.regular_join_writer(out, str(tmp_path / "store"), ["k"], how, joins.Side("at"), joins.Side("bt"), every=2, buckets=3)
    rng, left, right = random.Random(4), [], []
    key = lambda: rng.choice([None, 1, 1, 1, 2, 3, 4, 5, 6])
    for n in range(6):
        new_left = [(key(), rng.choice("xy"), n) for _ in range(rng.randrange(8))]
        new_right = [(key(), rng.choice("pq"), n) for _ in range(rng.randrange(5))]
        left, right = left + new_left, right + new_right
        for _ in range(2 if n == 3 else 1):
            deliver(spark, write, new_left, new_right, n)
        got = Counter(tuple(r) for r in joins.joined(spark, out).select("k", "a", "at", "b", "bt").collect())
        assert got == plain_join(left, right, how)


def test_each_side_is_forgotten_by_its_own_retention(spark, tmp_path):
    out = str(tmp_path / "out")
    write = joins.regular_join_writer(out, str(tmp_path / "store"), ["k"], "left", joins.Side("at", 100), joins.Side("bt", 10), every=2)
    deliver(spark, write, [(1, "one", 0), (2, "two", 0)], [(3, "three", 0)], 0)
    deliver(spark, write, [(9, "far", 50)], [], 1)
    # The right row of key 3 has gone; the left rows are still there.
    deliver(spark, write, [(3, "late", 51)], [(1, "ONE", 51)], 2)
    deliver(spark, write, [(9, "farther", 130)], [(1, "again", 52)], 3)
    # Now the left rows of the first delivery have gone, too: no pair, and no nulls to take back.
    deliver(spark, write, [], [(2, "TWO", 131), (1, "more", 131)], 4)
    got = {tuple(r) for r in joins.joined(spark, out).select("k", "a", "b").collect()}
    assert got == {(1, "one", "ONE"), (1, "one", "again"), (2, "two", None), (3, "late", None), (9, "far", None), (9, "farther", None)}
    kinds = [(r.kind, r.b) for r in spark.read.parquet(out).filter("k = 1").orderBy("batch", "kind").collect()]
    assert kinds == [("+I", None), ("+I", "ONE"), ("-D", None), ("+I", "again")]


# --- deadlines -------------------------------------------------------------------------------------


def test_a_key_is_sent_once_two_seconds_after_its_first_row(spark, tmp_path):
    clock = [0.0]
    out = str(tmp_path / "out")
    write = deadlines.deadline_writer(out, str(tmp_path / "s"), ["id"], ["v"], clock=lambda batch: BASE + dt.timedelta(seconds=clock[0]), every=2)

    def batch(n, now, *rows):
        clock[0] = now
        write(spark.createDataFrame(list(rows), "id string, v int, note string"), n)
        return sorted((r.id, r.v, r.note) for r in spark.read.parquet(sinks.batch_folder(out, n)).collect())

    assert batch(0, 0, ("a", 1, "first"), ("a", 1, "tie")) == []
    assert batch(1, 1, ("a", 3, "newest"), ("b", 1, "b"), (None, 1, "no key")) == []
    assert batch(1, 1, ("a", 3, "newest"), ("b", 1, "b"), (None, 1, "no key")) == []
    assert batch(2, 1.5, ("a", 2, "older")) == []
    assert batch(3, 2, ("a", 9, "too late")) == [("a", 3, "newest")]
    assert batch(4, 2.5, ("a", 10, "closed")) == []
    assert batch(5, 3.5) == [("b", 1, "b")]
    assert batch(6, 99, ("b", 5, "closed"), ("c", 1, "c")) == []
    assert batch(7, 101, ("c", 1, "equal, but later")) == [("c", 1, "c")]


def test_a_heartbeat_fires_deadlines_when_no_rows_come(spark, tmp_path):
    """Rows of one key once a second, then nothing: the running stream sends it once, without further input."""
    feed, schema = tmp_path / "in", "id string, v int"
    feed.mkdir()
    out = str(tmp_path / "out")
    write = deadlines.deadline_writer(out, str(tmp_path / "s"), ["id"], ["v"])
    stream = deadlines.with_heartbeat(spark.readStream.schema(schema).parquet(str(feed)))
    query = sinks.each_batch(stream, write, str(tmp_path / "check"), now=False)
    try:
        for k in range(4):
            spark.createDataFrame([("busy", k)], schema).coalesce(1).write.mode("append").parquet(str(feed))
            time.sleep(1)
        end = time.time() + 60
        sent = []
        while time.time() < end and not sent:
            time.sleep(1)
            sent = spark.read.schema(schema).parquet(f"{out}/batch=*").collect() if list((tmp_path / "out").glob("batch=*/_SUCCESS")) else []
        time.sleep(3)
    finally:
        query.stop()
    assert [r.id for r in spark.read.schema(schema).parquet(f"{out}/batch=*").collect()] == ["busy"]


# --- rows near in time -------------------------------------------------------------------------------


def at(second):
    return BASE + dt.timedelta(seconds=second)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_near_rows_and_lonely_ones_over_deliveries(spark, tmp_path, how):
    """Deliveries in any order within the delay, a hot key, equal rows, null keys, a repeat, one row too late."""
    out, rng = str(tmp_path / "out"), random.Random(11)
    write = joins.interval_join_writer(out, str(tmp_path / "s"), ["k"], "a", "b", 5, how, delay_s=20)
    left, right = [], []
    for n in range(5):
        low = n * 25
        new = [[(rng.choice(["hot", "hot", "x", None]), f"{side}{n}-{j // 2}", at(low + rng.randrange(40))) for j in range(14)] for side in "lr"]
        if n == 4:
            new[0].append(("x", "too late", at(1)))
        a = spark.createDataFrame(new[0], "k string, li string, a timestamp")
        b = spark.createDataFrame(new[1], "k string, ri string, b timestamp")
        for _ in range(2 if n == 2 else 1):
            write(joins.two_sides(a, b), n)
        left += [r for r in new[0] if r[1] != "too late"]
        right += new[1]
    mark = min(max(r[2] for r in left), max(r[2] for r in right)) - dt.timedelta(seconds=20)
    gap = dt.timedelta(seconds=5)
    expected, met_left, met_right = Counter(), set(), set()
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            if x[0] is not None and x[0] == y[0] and abs(x[2] - y[2]) <= gap:
                expected[(x[0], x[1], y[1])] += 1
                met_left.add(i)
                met_right.add(j)
    if how in ("left", "full"):
        expected.update((x[0], x[1], None) for i, x in enumerate(left) if i not in met_left and x[2] + gap < mark)
    if how in ("right", "full"):
        expected.update((y[0], None, y[1]) for j, y in enumerate(right) if j not in met_right and y[2] + gap < mark)
    got = Counter(tuple(r) for r in spark.read.parquet(out).select("k", "li", "ri").collect())
    assert got == expected
    late = spark.read.parquet(incremental.late_folder(out)).filter("_left.li = 'too late'").count()
    assert late == 1


def test_a_hot_key_is_spread_over_its_slices_in_a_full_join(spark):
    """No task of the join gets a large part of a key that holds nearly all rows."""
    from tidehouse.operators.intervals import interval_join

    rows = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(START) + F.col("id")).alias("a"))
    with settings(spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = interval_join(rows, rows.withColumnRenamed("a", "b"), ["k"], "a", "b", -5, 5)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 0.15 * sum(sizes)


# --- tables with deletions -----------------------------------------------------------------------


def test_deletions_hide_late_older_rows_until_nothing_is_left_to_hide(spark, tmp_path):
    """Delete, a late older update, an insert anew, and 25 batches in which the markers outlive merging, then go."""
    table = tables.KeyedTable(str(tmp_path / "t"), ["id"], ["ts"], deleted="name IS NULL", keep_deleted_s=5, every=2, buckets=2)
    write = table.writer()

    def batch(n, *rows):
        write(spark.createDataFrame([*rows, (f"other{n}", n, "x")], "id string, ts long, name string"), n)
        return {r.id: r.name for r in table.read(spark).collect() if not r.id.startswith("other")}

    with settings(spark, {"spark.sql.shuffle.partitions": "1"}):
        assert batch(0, ("a", 0, "first"), ("b", 0, "kept")) == {"a": "first", "b": "kept"}
        assert batch(1, ("a", 1, None), ("c", 1, None)) == {"b": "kept"}
        assert batch(2, ("a", 0, "late and older")) == {"b": "kept"}
        assert batch(2, ("a", 0, "late and older")) == {"b": "kept"}
        assert batch(3, ("a", 3, "anew"), ("b", 3, None)) == {"a": "anew"}
        for n in range(4, 25):
            rows = [("b", 2, "still older")] if n == 6 else []
            assert batch(n, *rows) == {"a": "anew"}
            if n == 7:
                assert {"b", "c"} & {r.id for r in table.store.before(spark).filter("_gone").collect()} == {"b"}
    # The marker of c went with the merge of batches 0 to 7, that of b with the one of batches 0 to 15.
    assert not table.store.before(spark).filter("_gone").count()
    like = spark.createDataFrame([("a",), ("b",), ("other9",)], "id string")
    assert {r.id for r in table.read(spark, like).collect()} == {"a", "other9"}


@pytest.mark.parametrize("arrival", [0, 1])
def test_of_dimension_rows_of_one_second_the_last_to_arrive_wins(spark, tmp_path, arrival):
    config = spark.createDataFrame([("part", "dim_part", "id,name", "id", None)], S.CONFIG_ROW)
    rows = [("insert", "again", 7 + arrival), ("update", "changed", 8 - arrival)]
    schema = "database string, table string, type string, ts long, data map<string,string>, old map<string,string>, seq struct<pos:long>"
    write = tables.dimensions_writer(str(tmp_path / "d"), lambda: config)
    write(spark.createDataFrame([("shop", "part", kind, 5, {"id": "1", "name": name}, None, (pos,)) for kind, name, pos in rows], schema), 0)
    got = tables.read_dimension(spark, str(tmp_path / "d"), "dim_part", config).collect()
    assert [tuple(r) for r in got] == [("1", ["changed", "again"][arrival])]


# --- patterns and versions ---------------------------------------------------------------------------


def test_patterns_against_one_attempt_after_the_other(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice(["hot", "hot", "hot", "u", None]), rng.choice("abc"), BASE + dt.timedelta(milliseconds=rng.randrange(900_000))) for k in range(1500)]
    events = spark.createDataFrame([*rows, (9999, "u", "a", None)], "id int, mid string, page string, ts timestamp")
    pattern = patterns.Pattern.begin("one", F.col("page") == "a", 7).next("two", F.col("page") == "b").next("three", F.col("page") != "c")
    got = Counter((r.id, r.outcome, r.reached, r.two and r.two.id, r.three and r.three.id) for r in patterns.matched(events, pattern, "mid", "ts", ["id"], ["id"], 20).collect())
    expected, span = Counter(), dt.timedelta(seconds=7)
    for mid in ("hot", "u", None):
        own = sorted((r for r in rows if r[1] == mid), key=lambda r: (r[3], r[0]))
        for k, first in enumerate(own):
            if first[2] != "a":
                continue
            found, outcome = [], "match"
            for step, fits in enumerate((lambda p: p == "b", lambda p: p != "c")):
                after = own[k + 1 + step] if k + 1 + step < len(own) else None
                if after is None or after[3] - first[3] >= span:
                    outcome = "timeout"
                    break
                if not fits(after[2]):
                    outcome = None
                    break
                found.append(after[0])
            if outcome:
                expected[(first[0], outcome, 1 + len(found), *[*found, None, None][:2])] += 1
    assert got == expected and {o for _, o, *_ in expected} == {"match", "timeout"}


def test_a_record_between_two_configurations_gets_the_first(spark):
    row = lambda table, columns: (table, "dim", columns, None, None)
    log = [
        (None, row("t", "id,log1"), "u", 5000), (None, row("t", "id,log2"), "u", 9000), (None, row("t", "id,snapshot"), "r", 2000),
        (row("t", "id,log2"), None, "d", 12000), (None, row("new", "id"), "c", 7000),
    ]
    versions = routing.config_versions(spark.createDataFrame(log, S.CONFIG_CHANGE))
    changes = [("shop", t, "insert", ts, {"id": f"{t}{ts}", "snapshot": "s", "log1": "1", "log2": "2"}, None) for t in ("t", "new") for ts in (1, 4, 5, 8, 9, 12)]
    got = {r.pk: set(r.data) - {"id"} for r in routing.routed_as_of(spark.createDataFrame(changes, S.CHANGE), versions).collect()}
    assert got == {"t1": {"snapshot"}, "t4": {"snapshot"}, "t5": {"log1"}, "t8": {"log1"}, "t9": {"log2"}, "new8": set(), "new9": set(), "new12": set()}
