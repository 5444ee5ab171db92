"""Column functions on hand-made values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidehouse.functions import times, values
from tidehouse.operators import records, routing
from tidehouse.plans import metrics
from tidehouse.sources import topics
from tidehouse.schemas import APP_LOG, CHANGE


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_fractions_are_decimal_fractions(spark):
    cases = [
        ("2031-12-09 07:00:01.700Z", "2031-12-09 07:00:01.7Z", 0),
        ("2031-12-09 07:00:01.069Z", "2031-12-09 07:00:01.3Z", -1),
        ("2031-12-09 07:00:01.218Z", "2031-12-09 07:00:01.21Z", 1),
        ("2031-12-09 07:00:02Z", "2031-12-09 07:00:01.999Z", 1),
    ]
    df = spark.createDataFrame(cases, "a string, b string, expected int")
    got = df.select(times.compare_fractional(F.col("a"), F.col("b")).alias("c"), "expected")
    assert all(r.c == r.expected for r in got.collect())


def test_epoch_of_day_text(spark):
    row = one(
        spark,
        times.epoch_ms(F.lit("2027-06-30"), full=False).alias("day"),
        times.epoch_ms(F.lit("2027-06-30 05:06:07")).alias("full"),
        times.epoch_ms(F.lit("not a time")).alias("bad"),
        times.epoch_second_text(F.lit(1814331967000)).alias("text"),
    )
    assert (row.day, row.full, row.bad) == (1814313600000, 1814331967000, None)
    assert row.text == "2027-06-30 05:06:07"


def test_session_zone_decides_texts(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        row = one(spark, times.epoch_second_text(F.lit(1814331967000)).alias("t"),
                  times.epoch_ms(F.lit("2027-06-30 13:06:07")).alias("ms"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.t, row.ms) == ("2027-06-30 13:06:07", 1814331967000)


def test_amount_has_four_decimals(spark):
    row = one(spark, values.amount(F.lit("3"), F.lit("12.50")).alias("a"),
              values.amount(F.lit("x"), F.lit("1")).alias("b"))
    assert (row.a, row.b) == ("37.5000", None)


def test_changed_sees_null_values(spark):
    row = one(spark, values.changed(F.lit('{"using_time":null}'), "using_time").alias("a"),
              values.changed(F.lit('{"x":1}'), "using_time").alias("b"),
              values.changed(F.lit(None).cast("string"), "using_time").alias("c"))
    assert (row.a, row.b, row.c) == (True, False, False)


def test_words_of_a_mixed_text(spark):
    row = one(spark, values.words(F.lit("Nordwind TeeKanne (B77) 900ML 青瓷 2L茶壶")).alias("w"))
    assert row.w == ["nordwind", "teekanne", "b77", "900ml", "青", "瓷", "2l", "茶", "壶"]


def test_text_without_words_gives_no_row(spark):
    df = spark.createDataFrame([("!!!",), ("ok",)], "key_word string").withColumn(
        "ts", F.current_timestamp())
    assert [r.word for r in metrics.keyword_words(df).collect()] == ["ok"]


def test_pruning_keeps_listed_columns(spark):
    data = F.create_map(*[F.lit(x) for x in
                          ("id", "84", "label", "kiln", "colour", "green")])
    row = one(spark, routing.pruned(data, F.lit("id,label")).alias("d"))
    assert row.d == {"id": "84", "label": "kiln"}


def test_dimension_schema_defaults_to_id():
    schema = routing.dimension_schema("id,name")
    assert [(f.name, f.nullable) for f in schema] == [("id", False), ("name", True)]


def test_clean_and_dirty_lines(spark):
    lines = spark.createDataFrame(
        [('{"database":"shop","table":"t","type":"insert","ts":5,"data":{"id":1},"old":null}',),
         ("junk",), ("",), (None,), ('{"database":',), ("[1,2]",)], "value string")
    good = topics.change_records(topics.lines(lines)).collect()
    assert [(r.database, r.data, r.old) for r in good] == [("shop", {"id": "1"}, None)]
    bad = records.dirty_lines(topics.lines(lines), CHANGE)
    assert sorted(r.value for r in bad.collect()) == ["[1,2]", "junk", '{"database":']


def test_log_branches(spark):
    lines = spark.createDataFrame(
        [
            ('{"common":{"mid":"m1"},"start":{"entry":"icon"},"displays":[{"item":"1"}],"ts":1}',),
            ('{"common":{"mid":"m2"},"page":{"page_id":"home"},"err":{"c":1},'
             '"displays":[{"item":"7"},{"item":"8"}],"actions":[{"action_id":"a","ts":9}],"ts":2}',),
            ('{"common":{"mid":"m3"},"page":{"page_id":"cart"},"displays":[],"ts":3}',),
        ],
        "value string",
    )
    log = records.clean_records(lines, APP_LOG)

    def mids(df):
        return sorted(r.common.mid for r in df.select("common").collect())

    assert mids(records.start_records(log)) == ["m1"]
    assert mids(records.error_records(log)) == ["m2"]
    assert mids(records.page_records(log)) == ["m2", "m3"]
    shown = records.display_records(log).collect()
    assert [(r["item"], r.page_id, r.ts) for r in shown] == [("7", "home", 2), ("8", "home", 2)]
    assert [(r.action_id, r.ts) for r in records.action_records(log).collect()] == [("a", 2)]
    assert not {"displays", "actions"} & set(records.page_records(log).columns)


def test_comma_lines(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()),
                           T.StructField("vc", T.DoubleType()), T.StructField("ts", T.LongType())])
    lines = spark.createDataFrame([("a,1.5,7",), ("b,x",)], "value string")
    got = [tuple(r) for r in topics.comma_lines(lines, schema).collect()]
    assert got == [("a", 1.5, 7), ("b", None, None)]
