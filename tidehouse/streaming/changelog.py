"""Change logs with retractions: rows of a changing result with their kind, and back.

``+I`` and ``+U`` bring a row, ``-U`` and ``-D`` take one away; ``U`` marks the two halves of a row that is replaced under the same id.
Adding up the signs of equal rows replays a log to the table it describes, whatever the order of rows, so a log can be compacted,
stored by key and counted by windows that subtract.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.operators.parts import FILE_CLEANUP
from tidehouse.session import settings
from tidehouse.streaming import sinks
from tidehouse.streaming.buckets import BUCKET, CODEC, BucketStore
from tidehouse.streaming.stores import BATCH

KIND = "kind"
_SIGN, _ROW = "_sign", "_row"
#: Up to so many rows taken back, their hashes are broadcast.
FEW_GONE = 500_000
#: A batch with more bytes of files than this for each core is gone through in groups.
GROUP_BYTES = 24 << 20


def sign() -> Column:
    """1 for a row that comes, -1 for one that goes."""
    return F.when(F.col(KIND).startswith("-"), -1).otherwise(1)


def _comparable(df: DataFrame) -> DataFrame:
    """Maps as sorted entries, so that rows can be grouped."""
    maps = {f.name: F.array_sort(F.map_entries(f.name)) for f in df.schema if isinstance(f.dataType, T.MapType)}
    return df.withColumns(maps) if maps else df


def _restored(df: DataFrame, schema: T.StructType) -> DataFrame:
    maps = {f.name: F.map_from_entries(f.name) for f in schema if isinstance(f.dataType, T.MapType)}
    return df.withColumns(maps) if maps else df


def _summed(signed: DataFrame, schema: T.StructType, *aggregates: Column) -> DataFrame:
    """One row for each copy that is left when equal rows have met, with their sign; no copies are gathered."""
    names = schema.names
    left = signed.groupBy(*names).agg(F.sum(_SIGN).alias(_SIGN), *aggregates).filter(F.col(_SIGN) != 0)
    copies = left.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs(F.col(_SIGN))))).drop("_copy")
    return _restored(copies.withColumn(_SIGN, F.signum(_SIGN).cast("int")), schema)


def difference(new: DataFrame, old: DataFrame | None, ids: Sequence[str] = ()) -> DataFrame:
    """The changes from ``old`` to ``new`` with their ``kind``; ``ids`` name a row, so that its replacement is an update."""
    if old is None:
        # Every row is a new one: nothing to meet, so nothing to shuffle.
        return new.withColumn(KIND, F.lit("+I"))
    signed = _comparable(new).withColumn(_SIGN, F.lit(1)).unionByName(_comparable(old).withColumn(_SIGN, F.lit(-1)))
    rows = _summed(signed, new.schema)
    kind = F.when(F.col(_SIGN) > 0, "+I").otherwise("-D")
    if ids:
        same = Window.partitionBy(*ids)
        replaced = (F.min(_SIGN).over(same) < 0) & (F.max(_SIGN).over(same) > 0)
        kind = F.when(replaced, F.when(F.col(_SIGN) > 0, "+U").otherwise("-U")).otherwise(kind)
    return rows.withColumn(KIND, kind).drop(_SIGN)


def _own(log: DataFrame) -> T.StructType:
    return T.StructType([f for f in log.schema if f.name not in (KIND, BATCH, "batch")])


def replayed(log: DataFrame) -> DataFrame:
    """The table that a log describes, repeated rows included."""
    schema = _own(log)
    signed = _comparable(log.withColumn(_SIGN, sign()).select(*schema.names, _SIGN))
    return _summed(signed, schema).filter(F.col(_SIGN) > 0).drop(_SIGN)


def standing(log: DataFrame) -> DataFrame:
    """``replayed`` for a log that lies in files: only rows that were taken back, and those like them, are shuffled."""
    schema = _own(log)
    gone = log.filter(sign() < 0).count()
    if not gone:
        return log.select(*schema.names)
    if gone > FEW_GONE:
        return replayed(log)
    signed = _comparable(log.withColumn(_SIGN, sign()).select(*schema.names, _SIGN)).withColumn(_ROW, F.xxhash64(*schema.names))
    met = F.broadcast(signed.filter(F.col(_SIGN) < 0).select(_ROW).distinct())
    untouched = _restored(signed.filter(F.col(_SIGN) > 0).join(met, _ROW, "left_anti").drop(_ROW, _SIGN), schema)
    left = _summed(signed.join(met, _ROW, "left_semi").drop(_ROW), schema)
    return untouched.unionByName(left.filter(F.col(_SIGN) > 0).drop(_SIGN))


def compacted(log: DataFrame) -> DataFrame:
    """Fewer rows of the same meaning; with what came before, they still replay to the same table."""
    schema = _own(log)
    signed = _comparable(log.withColumn(_SIGN, sign()).select(*schema.names, _SIGN, BATCH))
    rows = _summed(signed, schema, F.max(BATCH).alias(BATCH))
    return rows.withColumn(KIND, F.when(F.col(_SIGN) > 0, "+I").otherwise("-D")).drop(_SIGN)


def log_store(path: str, keys: Sequence[str], **options) -> BucketStore:
    """A log by key, compacted whenever runs are merged."""
    return BucketStore(path, keys, compacted, **options)


def changes_writer(
    out: str, rows: BucketStore, results: BucketStore, compute: Callable[[DataFrame], DataFrame], ids: Sequence[str] = (),
    together: Column | None = None,
) -> sinks.BatchWriter:
    """Recomputes the keys that a micro-batch touches and writes how their result has changed.

    ``compute`` gets all rows of the touched keys and its result carries the keys; ``results`` (a ``log_store`` by the same keys)
    remembers what was written. Rows that come late correct what was written before, with rows taken back.

    A batch is first put into the store and read from there as often as it is needed: a persisted copy of it would lie on the
    executors' disks besides, and its blocks come back into memory whole. A large one is gone through by groups of keys, so that the
    shuffle files of one group, not of the batch, are on the disks. ``together``: ids that ``compute`` compares across keys; where one of
    them occurs in several groups' keys, there is one group.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, to = batch.sparkSession, sinks.batch_folder(out, batch_id)
        put = rows.put(batch, batch_id)
        groups = rows.groups(spark, batch_id, GROUP_BYTES * spark.sparkContext.defaultParallelism)

        def every(fresh: DataFrame) -> DataFrame:
            earlier = rows.touched(fresh, batch_id)
            return fresh if earlier is None else fresh.unionByName(earlier.drop(BATCH))

        with settings(spark, {FILE_CLEANUP: "true"} if len(groups) > 1 else {}):
            if len(groups) > 1 and together is not None and rows.split(every(put.drop(BUCKET)), together):
                groups = [F.lit(True)]
            for k, group in enumerate(groups):
                fresh = put.filter(group).drop(BUCKET)
                known = results.touched(fresh, batch_id)
                log = difference(compute(every(fresh)), None if known is None else replayed(known), ids)
                log.write.mode("append" if k else "overwrite").options(**CODEC).parquet(to)
        rows.settle(spark, batch_id)
        results.append(spark.read.parquet(to), batch_id)

    return write


def table(spark: SparkSession, out: str) -> DataFrame:
    """The table that the log written below ``out`` describes by now."""
    return standing(spark.read.parquet(out))
