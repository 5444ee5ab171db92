"""A result computed part by part, where its shuffles are large against its files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidehouse.operators.lookup import _UNKNOWN, source_bytes
from tidehouse.session import run_dir, settings

Cut = Callable[[DataFrame], DataFrame]
# Bytes of sources for each core and part.
PART_BYTES = 16 << 20
# Every part reads the sources once.
MOST_PARTS = 8
# Spark's own setting: the shuffle files of a query go when it has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def in_parts(make: Callable[[Cut], DataFrame], keys: Sequence[str], label: str) -> DataFrame:
    """The rows that ``make`` gives, as a table in the shared folder, written in parts by a hash of ``keys``, so that the shuffle files of
    one part are on the disks, not of all. ``make`` gets what cuts its inputs down to a part; its rows must meet within equal keys only.
    Small tables and streams are not written but made whole."""
    whole = make(lambda df: df)
    spark = whole.sparkSession
    size = _UNKNOWN if whole.isStreaming else source_bytes(whole)
    count = 1 if size >= _UNKNOWN else min(MOST_PARTS, -(-size // (PART_BYTES * spark.sparkContext.defaultParallelism)))
    if count <= 1:
        return whole
    path, part = run_dir(spark, label), F.pmod(F.xxhash64(*keys), F.lit(count))
    with settings(spark, {FILE_CLEANUP: "true"}):
        for k in range(count):
            make(lambda df, k=k: df.filter(part == k)).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(whole.schema).parquet(path)
