"""Static tables: dictionary and configuration snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehouse.schemas import DICTIONARY


def read_dictionary(
    spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """Dictionary rows from parquet, or from a database with Spark's JDBC reader options."""
    raw = spark.read.format("jdbc").options(**jdbc).load() if jdbc else spark.read.parquet(path)
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in DICTIONARY.fields])
