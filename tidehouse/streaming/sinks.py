"""Sinks: append topics, keyed tables, window results, dimension tables, fan-out.

Every micro-batch writes its own ``batch=<id>`` folder and replaces it when the batch is run again
after a failure, so folders hold nothing twice. A broker topic is written at least once, and a
database table gets a repeated batch again; its batch number tells the copies apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidehouse.operators import routing
from tidehouse.operators.keyed import newest_per_key
from tidehouse.streaming import stores

BatchWriter = Callable[[DataFrame, int], None]


def as_lines(df: DataFrame) -> DataFrame:
    """Records as JSON text in one ``value`` column."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def append_topic(
    df: DataFrame, topic: str, checkpoint: str, servers: str | None = None, now: bool = True
) -> StreamingQuery:
    """Appends JSON lines to a topic: a broker topic with ``servers``, else a folder."""
    writer = as_lines(df).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if servers:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
        writer = writer.option("topic", topic)
    else:
        writer = writer.format("parquet").option("path", topic)
    return (writer.trigger(availableNow=True) if now else writer).start()


def append_rows(df: DataFrame, path: str, checkpoint: str, now: bool = True) -> StreamingQuery:
    """Appends typed rows to a parquet folder, for the next hop."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if now else writer).start()


def each_batch(
    df: DataFrame, write: BatchWriter, checkpoint: str, now: bool = True
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if now else writer).start()


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def upsert_writer(path: str, keys: Sequence[str], version: Sequence[str], every: int = 20) -> BatchWriter:
    """Keeps the newest row per key; after ``every`` micro-batches the table is rewritten compacted."""
    store = stores.keyed_store(path, keys, version, every)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.append(newest_per_key(batch, keys, version), batch_id)

    return write


def read_latest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    version: Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """Current row per key; of equal versions the later batch wins. ``deleted`` marks removals."""
    rows = newest_per_key(stores.Store(path).before(spark), keys, [*version, stores.BATCH])
    rows = rows.drop(stores.BATCH)
    return rows.filter(f"NOT ({deleted})") if deleted else rows


def compact_latest(
    spark: SparkSession, path: str, to: str, keys: Sequence[str], version: Sequence[str]
) -> None:
    """Rewrites a keyed table with one row per key, as batch -1 of a new folder."""
    newest = newest_per_key(stores.Store(path).before(spark), keys, [*version, stores.BATCH])
    newest.withColumn(stores.BATCH, F.lit(-1).cast("long")).write.mode("overwrite").parquet(batch_folder(to, -1))


def window_writer(
    columns: Sequence[str],
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    transient: Sequence[str] = (),
) -> BatchWriter:
    """Writes window results with ``columns`` in the table's order, without transient ones.

    A database table gets the batch number as well, so that a repeated batch can be recognised.
    """
    kept = [c for c in columns if c not in transient]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*kept)
        if jdbc:
            rows = rows.withColumn("batch", F.lit(batch_id))
            rows.write.format("jdbc").options(**jdbc).mode("append").save()
        else:
            rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def refreshed_writer(
    read: Callable[[], DataFrame],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    write: BatchWriter,
) -> BatchWriter:
    """Combines every micro-batch with a table as it is at that moment, then writes the result."""

    def refreshed(batch: DataFrame, batch_id: int) -> None:
        write(combine(batch, read()), batch_id)

    return refreshed


def dimension_writer(path: str, read_config: Callable[[], DataFrame]) -> BatchWriter:
    """Writes every configured record to the folder of its target table.

    The configuration is read anew for each micro-batch, before the records, so a record never
    meets an older configuration than the one in force when its batch began.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = routing.newest_dimension_rows(routing.routed(batch, read_config()))
        rows.write.mode("overwrite").partitionBy("sink_table").parquet(
            batch_folder(path, batch_id)
        )

    return write


def read_dimension(spark: SparkSession, path: str, sink_table: str, config: DataFrame) -> DataFrame:
    """Newest rows of one target over all micro-batches, typed by the target's configuration row."""
    rows = spark.read.parquet(path).filter(F.col("sink_table") == sink_table)
    newest = newest_per_key(rows, ["sink_table", "pk"], ["ts", "batch", "type"])
    return routing.dimension_table(newest, sink_table, routing.configured_schema(config, sink_table))


def fan_out_writer(
    root: str, branches: dict[str, Callable[[DataFrame], DataFrame]]
) -> BatchWriter:
    """Writes several selections of one micro-batch, which is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, select in branches.items():
                lines = as_lines(select(batch))
                lines.write.mode("overwrite").parquet(batch_folder(f"{root}/{name}", batch_id))
        finally:
            batch.unpersist()

    return write
