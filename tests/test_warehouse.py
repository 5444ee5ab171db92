"""Jobs by name: pages to visitors to windows, with a restart between two deliveries."""

from __future__ import annotations

from tidehouse.operators.intervals import bounced_entries
from tidehouse.operators.keyed import first_per_day
from tidehouse.plans import metrics, traffic
from tidehouse.sources import samples
from tidehouse.streaming import warehouse

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_pages_to_windows_with_a_restart(spark, tmp_path):
    pages = samples.page_log(spark, SF, fast=True)
    folder, root = str(tmp_path / "pages"), str(tmp_path / "warehouse")
    half = pages.agg({"ts": "avg"}).first()[0]
    for part in (pages.filter(pages.ts.cast("double") < half), pages.filter(pages.ts.cast("double") >= half)):
        part.repartition(3).write.mode("append").parquet(folder)
        inputs = {"pages": spark.readStream.schema(pages.schema).parquet(folder)}
        for name in ("unique_visitors", "user_jumps"):
            warehouse.start(name, inputs, root).awaitTermination()
            inputs[name] = warehouse.follow(spark, name, root)
        warehouse.start("page_view_window", inputs, root).awaitTermination()
    visitors = first_per_day(traffic.entry_pages(pages), ["mid"], "ts", [])
    assert rows(warehouse.latest(spark, "unique_visitors", root).select("mid", "ts")) == rows(visitors.select("mid", "ts"))
    jumps = warehouse.latest(spark, "user_jumps", root)
    assert jumps.count() > 0 and not jumps.join(bounced_entries(pages, "mid", "ts", ["event_id"]), "event_id", "left_anti").count()
    expected = metrics.page_view_window(metrics.traffic_union(pages, visitors, jumps))
    assert rows(warehouse.latest(spark, "page_view_window", root)) == rows(expected)
