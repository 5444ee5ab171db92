"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS    local executor threads (default: all)
BENCH_QUERIES comma-separated names (default: the list below)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tidehouse.stream_queries  # noqa: E402, F401  (registers the streaming queries)
from tidehouse.queries import QUERIES  # noqa: E402
from tidehouse.session import build_session  # noqa: E402

HEADLINE = [
    "page_view_window", "unique_visitor", "user_jump", "fix_is_new", "keyword_window",
    "home_detail_uv", "user_login", "cart_uu_window", "user_register_window",
    "trade_spu_window", "order_detail_wide", "pay_detail_wide", "order_refund_wide",
    "refund_pay_wide", "lookup_inner", "interval_join", "dim_chain_enrich", "dim_upsert_latest",
    "latest_per_key", "log_split_page", "src_cdc_envelope", "stream_unique_visitor",
    "stream_keyword_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    extra = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", extra)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        # Every column of every row is computed, nothing is kept.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    line = {
        "metric": "headline queries, wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
