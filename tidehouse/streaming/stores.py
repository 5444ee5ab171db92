"""Tables that micro-batches keep: one delta for each batch, a snapshot from time to time, and nothing older.

A batch that is run again reads only what earlier batches left and replaces its own folders. A snapshot holds everything up to its
batch, compacted; folders that only an older snapshot needs are removed, one snapshot late, so a repeated batch still finds its input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehouse.operators.keyed import newest_per_key

BATCH = "_batch"


class Folder:
    """A folder in whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.jvm = spark._jvm

    def names(self) -> list[str]:
        if not self.files.exists(self.path):
            return []
        return sorted(status.getPath().getName() for status in self.files.listStatus(self.path))

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def finished(self, name: str) -> bool:
        return self.files.exists(self.jvm.org.apache.hadoop.fs.Path(self.child(name), "_SUCCESS"))

    def size(self, name: str) -> int:
        """Bytes of all files below a name."""
        return self.files.getContentSummary(self.child(name)).getLength()

    def remove(self, name: str) -> None:
        self.files.delete(self.child(name), True)

    def text(self, name: str) -> str | None:
        """A small file's text; None without the file."""
        if not self.files.exists(self.child(name)):
            return None
        stream = self.files.open(self.child(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str, replace: bool = False) -> bool:
        """Writes a small file; without ``replace`` only if there is none yet. Whether it was written."""
        if not replace and self.files.exists(self.child(name)):
            return False
        stream = self.files.create(self.child(name), replace)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True


class Store:
    """Rows of all micro-batches below ``path``; ``compact`` reduces them for a snapshot after ``every`` batches."""

    def __init__(self, path: str, compact: Callable[[DataFrame], DataFrame] | None = None, every: int = 20) -> None:
        self.path, self.every = path.rstrip("/"), every
        self.compact = compact or (lambda rows: rows)

    def _numbers(self, folder: Folder, kind: str) -> list[int]:
        names = [n for n in folder.names() if n.startswith(f"{kind}=") and folder.finished(n)]
        return sorted(int(n.partition("=")[2]) for n in names)

    def before(self, spark: SparkSession, batch_id: int | None = None, snapshots_before: int | None = None) -> DataFrame | None:
        """What the batches before ``batch_id`` (without it: all) left, with their number in ``_batch``."""
        folder = Folder(spark, self.path)
        limit = batch_id if batch_id is not None else 1 << 62
        oldest = limit if snapshots_before is None else snapshots_before
        snapshots = [n for n in self._numbers(folder, "snapshot") if n < oldest]
        base = snapshots[-1] if snapshots else -2
        paths = [f"{self.path}/snapshot={base}"] if snapshots else []
        paths += [f"{self.path}/batch={n}" for n in self._numbers(folder, "batch") if base < n < limit]
        return spark.read.parquet(*paths) if paths else None

    def append(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if (batch_id + 1) % self.every:
            return
        folder = Folder(spark, self.path)
        older = [n for n in self._numbers(folder, "snapshot") if n < batch_id]
        self.compact(self.before(spark, batch_id + 1, batch_id)).write.mode("overwrite").parquet(f"{self.path}/snapshot={batch_id}")
        if older:
            for name in folder.names():
                kind, _, number = name.partition("=")
                if kind == "batch" and int(number) <= older[-1] or kind == "snapshot" and int(number) < older[-1]:
                    folder.remove(name)


def keyed_store(path: str, keys: Sequence[str], version: Sequence[str], every: int = 20) -> Store:
    """Newest row of each key; of equal versions the later batch's."""
    return Store(path, lambda rows: newest_per_key(rows, keys, [*version, BATCH]), every)
