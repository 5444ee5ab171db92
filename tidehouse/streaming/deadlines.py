"""The newest version of a key, sent once, a fixed time after the key's first arrival.

The first version opens a buffer and sets its deadline by the clock, not by the records' time; newer versions replace it, whatever
their distance, until the deadline passes. Then the version is sent and the key is closed: what comes later changes nothing. Buffers are few, those of
the last seconds; closed keys are a bucketed store. A micro-batch sends what is due before it looks at its own rows, and a
heartbeat brings micro-batches when no rows come.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.operators.keyed import newest_per_key
from tidehouse.streaming import sinks
from tidehouse.streaming.buckets import BucketStore
from tidehouse.streaming.stores import Folder

OPENED = "_opened"
BEAT = "_beat"


def with_heartbeat(rows: DataFrame, per_second: int = 1) -> DataFrame:
    """``rows`` and, so many times a second, an empty one: micro-batches go on when no rows come."""
    beat = rows.sparkSession.readStream.format("rate").option("rowsPerSecond", per_second).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    return rows.withColumn(BEAT, F.lit(False)).unionByName(beat.select(*empty, F.lit(True).alias(BEAT)))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def deadline_writer(
    out: str, store: str, keys: Sequence[str], version: Sequence[str], wait_s: float = 2.0,
    clock: Callable[[DataFrame], dt.datetime] | None = None, every: int = 8,
) -> sinks.BatchWriter:
    """Sends each key's newest ``version`` below ``out`` once, when ``wait_s`` seconds have passed since its first arrival.

    Of equal versions the later arrival wins. ``clock`` tells the time of a micro-batch (by default the machine's).
    Rows with a null in a key are left out. A batch that is run again takes the clock anew, but reads the same buffers.
    """
    closed = BucketStore(f"{store}/closed", keys, every=every)
    waiting = f"{store}/waiting"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, batch.persist()
        try:
            now = clock(held) if clock else _now()
            rows = held.filter(f"NOT {BEAT}").drop(BEAT) if BEAT in held.columns else held
            for c in keys:
                rows = rows.filter(F.col(c).isNotNull())
            buffers = _buffers(spark, waiting, batch_id, rows)
            due = F.col(OPENED) <= F.lit(now - dt.timedelta(seconds=wait_s))
            sent = buffers.filter(due).drop(OPENED)
            sent.write.mode("overwrite").parquet(sinks.batch_folder(out, batch_id))
            sent = spark.read.parquet(sinks.batch_folder(out, batch_id)).select(*keys)
            gone = sent
            if (known := closed.touched(rows, batch_id)) is not None:
                gone = gone.unionByName(known.select(*keys))
            fresh = rows.join(gone.distinct(), list(keys), "left_anti").withColumn(OPENED, F.lit(now).cast("timestamp"))
            kept = buffers.filter(~due)
            every_row = kept.withColumn("_late", F.lit(0)).unionByName(fresh.withColumn("_late", F.lit(1)))
            opened = every_row.groupBy(*keys).agg(F.min(OPENED).alias("_first"))
            best = newest_per_key(every_row, keys, [*version, "_late"]).join(opened, list(keys)).withColumn(OPENED, F.col("_first"))
            best.drop("_late", "_first").write.mode("overwrite").parquet(sinks.batch_folder(waiting, batch_id))
            closed.append(sent, batch_id)
            folder = Folder(spark, waiting)
            for name in folder.names():
                if name.startswith("batch=") and int(name[6:]) < batch_id - 1:
                    folder.remove(name)
        finally:
            held.unpersist()

    return write


def _buffers(spark: SparkSession, waiting: str, batch_id: int, like: DataFrame) -> DataFrame:
    """The open buffers that the batch before left."""
    schema = T.StructType([*like.schema.fields, T.StructField(OPENED, T.TimestampType())])
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(sinks.batch_folder(waiting, batch_id - 1))
