"""Every job of the warehouse through ``start``, twice: a second run without new input changes nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidehouse.plans import actions, metrics, traffic
from tidehouse.session import settings
from tidehouse.sources import samples
from tidehouse.stream_queries import change_stream, lookups, pages_stream, table_stream
from tidehouse.streaming import warehouse

SF = "/root/testdata/sf0.001"
#: In the order of their hops.
ORDER = list(warehouse.JOBS)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    """The root below which all jobs have run, and what they gave the first time."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    changes = change_stream(spark, SF, *samples.CHANGE_TABLES)
    inputs = {"pages": pages_stream(spark, SF), "changes": changes, "app_log": samples.app_log(table_stream(spark, SF, "events"))}
    tables, counts = lookups(spark, SF), {}
    with settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        for again in range(2):
            for name in ORDER:
                warehouse.start(name, inputs, root, tables).awaitTermination()
                if not (warehouse.JOBS[name].rule or warehouse.JOBS[name].read):
                    inputs[name] = warehouse.follow(spark, name, root)
                n = warehouse.latest(spark, name, root, tables).count()
                assert counts.setdefault(name, n) == n
    return root, counts


def test_all_jobs_give_rows(house):
    assert len(house[1]) == 28 and all(house[1].values()), house[1]


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_jobs_give_the_tables_rows(spark, house):
    root, tables = house[0], lookups(spark, SF)
    log, pages = samples.change_log(spark, SF), samples.page_log(spark, SF)
    expected = {
        "coupon_pay": actions.coupon_pay(log), "favor_add": actions.favor_add(log),
        "keyword_window": metrics.keyword_window(metrics.keyword_words(metrics.search_keywords(metrics.whole_second_pages(pages)))),
        "register_window": metrics.register_window(actions.registrations(log)),
        "home_detail_window": metrics.home_detail_window(metrics.home_detail_first_visits(pages, ["event_id"])),
        "unique_visitors": traffic.unique_visitors(pages, ["event_id"]),
    }
    for name, table in expected.items():
        assert rows(warehouse.latest(spark, name, root, tables)) == rows(table), name


def test_the_page_topic_is_one_of_five(spark, house):
    split = warehouse.latest(spark, "log_split", house[0])
    assert {r.topic for r in split.select("topic").distinct().collect()} == set(warehouse.TOPICS)
    page = warehouse.topic(split, "page")
    assert page.count() and page.filter(F.get_json_object("value", "$.start").isNotNull()).count() == 0
