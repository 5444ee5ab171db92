"""Configuration-driven dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.operators.keyed import newest_per_key
from tidehouse.operators.lookup import MAX_BROADCAST_ROWS, is_small
from tidehouse.schemas import DIM_CHANGE_TYPES

DEFAULT_KEY = "id"


def latest_config(config_changes: DataFrame) -> DataFrame:
    """The newest configuration row of every source table."""
    rows = config_changes.filter(F.col("after").isNotNull()).select("after.*", "ts_ms")
    newest = newest_per_key(
        rows, ["source_table"], ["ts_ms", "sink_table", "sink_columns", "sink_pk"]
    )
    key = F.when(F.coalesce("sink_pk", F.lit("")) == "", DEFAULT_KEY).otherwise(F.col("sink_pk"))
    return newest.withColumn("sink_pk", key).drop("ts_ms")


def pruned(data: Column, sink_columns: Column) -> Column:
    """The entries of ``data`` that the comma-separated list names."""
    names = F.split(sink_columns, ",")
    return F.map_filter(data, lambda key, _: F.array_contains(names, key))


def routed(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change records of configured tables with their target, key and listed columns.

    Deletes and unknown tables are dropped. The configuration has one row per source table; it is
    broadcast when counted as small, otherwise the join shuffles and adaptive execution splits
    hot tables.
    """
    if is_small(config, MAX_BROADCAST_ROWS):
        config = F.broadcast(config)
    return _targets(changes.filter(F.col("type").isin(*DIM_CHANGE_TYPES)).join(config, F.col("table") == F.col("source_table")))


def config_versions(config_changes: DataFrame) -> DataFrame:
    """Every configuration a source table has had, with the milliseconds [``valid_from``, ``valid_to``) it was in force.

    Rows of the initial snapshot (op r) and of the log are ordered by time, a snapshot row before log rows of the same time, later
    columns only break ties. A table's first version counts from the beginning if it comes from the snapshot, as it was in force before
    anyone looked. A deletion ends the version before it. Source tables have few versions, so each table's are ordered in one task.
    """
    table = F.coalesce("after.source_table", "before.source_table")
    rows = config_changes.select(table.alias("_table"), "after.*", "ts_ms", (F.col("op") == "r").alias("_snapshot"), F.col("after").isNull().alias("_gone"))
    in_order = Window.partitionBy("_table").orderBy("ts_ms", F.col("_snapshot").desc(), F.col("_gone").desc(), "sink_table", "sink_columns", "sink_pk")
    first = F.row_number().over(in_order) == 1
    timed = rows.withColumns({
        "valid_from": F.when(first & F.col("_snapshot"), F.lit(-(1 << 62))).otherwise(F.col("ts_ms")),
        "valid_to": F.coalesce(F.lead("ts_ms").over(in_order), F.lit(1 << 62)),
    })
    key = F.when(F.coalesce("sink_pk", F.lit("")) == "", DEFAULT_KEY).otherwise(F.col("sink_pk"))
    kept = timed.filter("NOT _gone AND valid_from < valid_to").withColumn("sink_pk", key)
    return kept.drop("_table", "_snapshot", "_gone", "ts_ms")


def routed_as_of(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """As ``routed``, with the configuration that was in force at the time of each record (``ts``, in seconds)."""
    if is_small(versions, MAX_BROADCAST_ROWS):
        versions = F.broadcast(versions)
    ms = F.col("ts") * 1000
    kept = changes.filter(F.col("type").isin(*DIM_CHANGE_TYPES))
    joined = kept.join(versions, (F.col("table") == F.col("source_table")) & (ms >= F.col("valid_from")) & (ms < F.col("valid_to")))
    return _targets(joined)


def _targets(joined: DataFrame) -> DataFrame:
    """Target, key and listed columns of change records beside their configuration."""
    return joined.select(
        "sink_table", F.col("data")[F.col("sink_pk")].alias("pk"), "table", "type", "ts",
        pruned(F.col("data"), F.col("sink_columns")).alias("data"), *[c for c in ["seq"] if c in joined.columns],
    )


def newest_dimension_rows(rows: DataFrame) -> DataFrame:
    """Current content of all dimension tables: the newest row per target and key.

    Of rows of one second the last to arrive wins where the records carry their sequence.
    """
    return newest_per_key(rows, ["sink_table", "pk"], ["ts", "type"])


def dimension_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """All-text schema of a target table; the key column is not nullable."""
    key = sink_pk or DEFAULT_KEY
    return T.StructType(
        [T.StructField(name, T.StringType(), name != key) for name in sink_columns.split(",")]
    )


def configured_schema(config: DataFrame, sink_table: str) -> T.StructType:
    """Schema of a target from its configuration row (one row per target reaches the driver)."""
    row = config.filter(F.col("sink_table") == sink_table).select("sink_columns", "sink_pk").first()
    if row is None:
        raise ValueError(f"no configuration for {sink_table}")
    return dimension_schema(row.sink_columns, row.sink_pk)


def dimension_table(rows: DataFrame, sink_table: str, schema: T.StructType) -> DataFrame:
    """One target table as typed columns."""
    mine = rows.filter(F.col("sink_table") == sink_table)
    return mine.select(*[F.col("data")[name].alias(name) for name in schema.names])
