"""Keyed tables that micro-batches keep up to date: the newest row of each key, deletions included.

A deletion is a row of its own, a marker, which hides older rows however late they come. Markers outlive merging for
``keep_deleted_s`` seconds of the rows' time, then go with the merge that reaches the oldest rows, as nothing is left for them to hide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehouse.operators import routing
from tidehouse.operators.keyed import newest_per_key
from tidehouse.streaming import sinks
from tidehouse.streaming.buckets import BucketStore, newest
from tidehouse.streaming.stores import BATCH

DAY_S = 86400
GONE = "_gone"


class KeyedTable:
    """``version``: columns that tell which row of a key is newer, the first one its epoch second if markers are to go; of equal
    versions the later batch wins. ``deleted`` is true for a row that takes its key away."""

    def __init__(
        self, path: str, keys: Sequence[str], version: Sequence[str], deleted: str | None = None, keep_deleted_s: int = 7 * DAY_S,
        every: int = 8, buckets: int = 128, sort: Sequence[str] = (),
    ) -> None:
        self.keys, self.version, self.deleted = list(keys), list(version), deleted
        self.store = BucketStore(
            path, keys, newest(keys, version), every=every, buckets=buckets, time=version[0] if deleted else None, sort=sort,
            oldest=self._without_old_markers(keep_deleted_s) if deleted else None,
        )

    @staticmethod
    def _without_old_markers(keep_deleted_s: int):
        return lambda rows, time, mark: rows.filter(~(F.col(GONE) & (F.col(time) < F.lit(mark - keep_deleted_s))))

    def writer(self) -> sinks.BatchWriter:
        def write(batch: DataFrame, batch_id: int) -> None:
            gone = F.coalesce(F.expr(self.deleted), F.lit(False)) if self.deleted else F.lit(False)
            self.store.append(newest_per_key(batch.withColumn(GONE, gone), self.keys, self.version), batch_id)

        return write

    def read(self, spark: SparkSession, like: DataFrame | None = None) -> DataFrame:
        """The table by now; with ``like`` only the keys that occur there, and only their buckets."""
        stored = self.store.before(spark) if like is None else self.store.touched(like)
        rows = newest_per_key(stored, self.keys, [*self.version, BATCH])
        return rows.filter(f"NOT {GONE}").drop(GONE, BATCH)


def dimensions(path: str, every: int = 8) -> KeyedTable:
    """All dimension tables by target and key; deletions never reach them."""
    return KeyedTable(path, ["sink_table", "pk"], ["ts", "type"], every=every, sort=["sink_table"])


def dimensions_writer(path: str, read_config, every: int = 8) -> sinks.BatchWriter:
    """Takes the configured records of each micro-batch into their tables, by the configuration as it is when the batch begins."""
    keep = dimensions(path, every).writer()

    def write(batch: DataFrame, batch_id: int) -> None:
        keep(routing.newest_dimension_rows(routing.routed(batch, read_config())), batch_id)

    return write


def read_dimension(spark: SparkSession, path: str, sink_table: str, config: DataFrame) -> DataFrame:
    """One target as typed columns."""
    rows = dimensions(path).read(spark).filter(F.col("sink_table") == sink_table)
    return routing.dimension_table(rows, sink_table, routing.configured_schema(config, sink_table))
