"""Parsing text records and splitting an application log into its outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.functions.times import from_epoch_ms

BROKEN = "_broken"
SEQUENCE = "seq"


def with_parsed(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Adds ``record`` (parsed) and ``is_dirty``; a line is dirty when it is no JSON of this shape.

    The one-element explode keeps later filters on the record above the parsing step; pushed
    below it, they would parse every line a second time.
    """
    marked = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    parsed = F.from_json(
        F.col(value), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    )
    return lines.withColumn("record", F.explode(F.array(parsed))).withColumn(
        "is_dirty", F.col(f"record.{BROKEN}").isNotNull()
    )


def not_empty(lines: DataFrame, value: str = "value") -> DataFrame:
    """Drops tombstones: null or empty payloads."""
    return lines.filter(F.coalesce(F.col(value), F.lit("")) != "")


def clean_records(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parsed fields of the well-formed lines, and their ``seq`` where the source gave one."""
    kept = [SEQUENCE] if SEQUENCE in lines.columns else []
    good = with_parsed(not_empty(lines, value), schema, value).filter(~F.col("is_dirty"))
    return good.select(*[F.col(f"record.{name}").alias(name) for name in schema.names], *kept)


def dirty_lines(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The malformed lines, unchanged."""
    return (
        with_parsed(not_empty(lines, value), schema, value)
        .filter("is_dirty")
        .drop("record", "is_dirty")
    )


def start_records(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("start").isNotNull())


def error_records(logs: DataFrame) -> DataFrame:
    """Records with an error, whatever else they are; they also stay in the other outputs."""
    return logs.filter(F.col("err").isNotNull())


def page_records(logs: DataFrame) -> DataFrame:
    """Page views without their display and action lists."""
    return logs.filter(F.col("start").isNull()).drop("start", "displays", "actions")


def _per_element(logs: DataFrame, column: str) -> DataFrame:
    element = logs.schema[column].dataType.elementType
    own = [F.col(f"e.{name}").alias(name) for name in element.names if name != "ts"]
    return (
        logs.filter(F.col("start").isNull())
        .select(F.explode(column).alias("e"), "page.page_id", "common", "ts")
        .select(*own, "page_id", "common", "ts")
    )


def display_records(logs: DataFrame) -> DataFrame:
    """One row per display with the page, visitor and time of its parent."""
    return _per_element(logs, "displays")


def action_records(logs: DataFrame) -> DataFrame:
    """One row per action; the parent's time replaces the action's own."""
    return _per_element(logs, "actions")


def flat_pages(pages: DataFrame) -> DataFrame:
    """Page records as plain columns with ``ts`` as a timestamp."""
    return pages.select(
        "common.mid", "common.uid", "common.vc", "common.ch", "common.ar", "common.is_new",
        "page.page_id", "page.last_page_id", "page.item", "page.item_type", "page.during_time",
        from_epoch_ms(F.col("ts")).alias("ts"),
    )
