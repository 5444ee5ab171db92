"""Keyed state as tables cut into buckets, so that a micro-batch opens only the buckets its keys fall into.

Every micro-batch adds a *run*: its rows as they lie, sorted by bucket and key hash. ``every`` runs are merged into one of the
next level, with a folder for each bucket, ``every`` of those into one of the level above, and so on. A row is thus rewritten once a level, whatever the history's
length, and at most ``every - 1`` runs a level are live. Which runs make up the batches before one follows from its number alone: a
micro-batch that is run again reads the same ones and replaces its own. A merged run is removed a batch later.

With ``keep_s``, rows whose epoch second ``time`` lies more than that behind the newest earlier one are not read any more; merging
leaves them out, and a run in which all rows are that old is removed. Reading skips the folders of other buckets without opening a
file; inside a file, the sort and Bloom filters on the key hash skip row groups when there are few keys.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.operators.keyed import newest_per_key
from tidehouse.streaming.stores import BATCH, Folder

BUCKET, HASH = "_bucket", "_hash"
OWN = (BATCH, HASH, BUCKET)
#: Up to so many keys are pushed to the files as a list.
FEW_KEYS = 256
#: Runs hold long texts, which this packs far better than Parquet's default.
CODEC = {"compression": "zstd"}
#: Filters as large as their file's keys need, at most 128 KB.
BLOOM = {
    f"parquet.bloom.filter.enabled#{HASH}": "true", "parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(128 << 10),
}


def merged_sums(keys: Sequence[str], sums: Sequence[str], others: dict | None = None) -> Callable[[DataFrame], DataFrame]:
    """Merges partial rows of ``keys`` by adding up; ``others`` are further mergeable aggregates by name."""

    def merge(rows: DataFrame) -> DataFrame:
        # A sum keeps its column's type, so that merged rows can be merged again.
        aggregates = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums]
        aggregates += [make(c).alias(c) for c, make in (others or {}).items()]
        return rows.groupBy(*keys).agg(*aggregates, F.max(BATCH).alias(BATCH))

    return merge


def newest(keys: Sequence[str], version: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Keeps the newest row of each key; of equal versions the later batch's."""
    return lambda rows: newest_per_key(rows, keys, [*version, BATCH])


class BucketStore:
    """Rows by ``keys`` below ``path``. ``merge`` reduces rows of several batches to fewer with the same meaning; it gets and returns
    the rows' own columns and ``_batch``."""

    def __init__(
        self, path: str, keys: Sequence[str], merge: Callable[[DataFrame], DataFrame] | None = None, *, buckets: int = 128, every: int = 8,
        time: str | None = None, keep_s: int | None = None, sort: Sequence[str] = (),
        oldest: Callable[[DataFrame, str, int], DataFrame] | None = None,
    ) -> None:
        """``oldest`` (rows, time column, newest second) goes over merged rows that have no older ones behind them."""
        self.path, self.keys, self.merge = path.rstrip("/"), list(keys), merge or (lambda rows: rows)
        self.buckets, self.every, self.time, self.keep_s, self.sort, self.oldest = buckets, every, time, keep_s, list(sort), oldest

    # --- which runs ---

    def cover(self, n: int) -> list[tuple[int, int, int]]:
        """(level, first, last) of the runs that hold the batches before ``n``."""
        level, at, out = 0, 0, []
        while self.every ** (level + 1) <= n:
            level += 1
        while at < n:
            while self.every**level > n - at:
                level -= 1
            out.append((level, at, at + self.every**level - 1))
            at += self.every**level
        return out

    @staticmethod
    def _name(run: tuple[int, int, int]) -> str:
        return "run={}-{}-{}".format(*run)

    def _live(self, folder: Folder, runs: list[tuple[int, int, int]]) -> list[str]:
        return [name for name in map(self._name, runs) if folder.finished(name)]

    # --- reading ---

    def mark(self, spark: SparkSession, n: int) -> int | None:
        """The newest second of the batches before ``n``."""
        text = Folder(spark, self.path).text(f"_mark-{n - 1}") if n > 0 else None
        return int(text) if text else None

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame | None:
        if not names:
            return None
        schema = T.StructType.fromJson(json.loads(Folder(spark, self.path).text("_schema")))
        rows = None
        for name in names:
            # Runs are read one by one: each has its own bucket folders.
            run = spark.read.schema(schema).parquet(f"{self.path}/{name}")
            rows = run if rows is None else rows.unionByName(run)
        return rows

    def _fresh(self, spark: SparkSession, rows: DataFrame | None, n: int) -> DataFrame | None:
        newest_s = self.mark(spark, n) if self.keep_s is not None else None
        if rows is None or newest_s is None:
            return rows
        return rows.filter(F.col(self.time) >= newest_s - self.keep_s)

    def _runs(self, folder: Folder, n: int | None) -> tuple[list[str], int]:
        """The runs to read for the batches before ``n``, and that number; without it all that the folder has, whatever ``every`` its
        writer was given: from each end the longest run."""
        if n is not None:
            return self._live(folder, self.cover(n)), n
        found = [tuple(map(int, name[4:].split("-"))) for name in folder.names() if name.startswith("run=") and folder.finished(name)]
        runs, n = [], 0
        for run in sorted(found, key=lambda run: (run[1], -run[2])):
            if run[1] >= n:
                runs.append(self._name(run))
                n = run[2] + 1
        return runs, n

    def before(self, spark: SparkSession, n: int | None = None) -> DataFrame | None:
        """All rows that the batches before ``n`` (without it: all) left, with ``_batch``."""
        names, n = self._runs(Folder(spark, self.path), n)
        rows = self._fresh(spark, self._read(spark, names), n)
        return None if rows is None else rows.drop(HASH, BUCKET)

    def touched(self, rows: DataFrame, n: int | None = None) -> DataFrame | None:
        """What the batches before ``n`` (without it: all) left for the keys that occur in ``rows``, with ``_batch``."""
        spark = rows.sparkSession
        names, n = self._runs(Folder(spark, self.path), n)
        if not names:
            return None
        keys = rows.select(*self.keys).distinct().select(*self.keys, self._hash().alias(HASH))
        few = [r[0] for r in keys.select(HASH).limit(FEW_KEYS + 1).collect()]
        stored = self._fresh(spark, self._read(spark, names), n)
        if len(few) > FEW_KEYS:
            found = [r[0] for r in keys.select(self._bucket(F.col(HASH))).distinct().collect()]
            stored = stored.filter(F.col(BUCKET).isin(found))
        else:
            stored = stored.filter(F.col(BUCKET).isin(sorted({h % self.buckets for h in few})) & F.col(HASH).isin(few))
        return self.only(stored, keys).drop(HASH, BUCKET)

    def only(self, stored: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows with one of the ``keys``; null keys are keys."""
        wanted = keys.select(*[F.col(c).alias(f"_key_{c}") for c in self.keys])
        same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in self.keys]
        return stored.join(wanted, same, "left_semi")

    # --- writing ---

    def _hash(self):
        return F.xxhash64(*self.keys)

    def _bucket(self, value):
        return F.pmod(value, F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, run: tuple[int, int, int]) -> None:
        """A batch's own run moves no rows. A merged one has a folder for each bucket, and cuts a hot key by a hash of the whole row
        if there are more tasks than buckets."""
        spark = rows.sparkSession
        own = [c for c in rows.columns if c not in OWN]
        ready = rows.select(*own, F.col(BATCH).cast("long").alias(BATCH), self._hash().alias(HASH))
        ready = ready.withColumn(BUCKET, self._bucket(F.col(HASH)))
        folder = Folder(spark, self.path)
        if folder.text("_schema") is None:
            folder.create("_schema", T.StructType([T.StructField(f.name, f.dataType) for f in ready.schema]).json())
        path = f"{self.path}/{self._name(run)}"
        if run[0] == 0:
            ready.sortWithinPartitions(BUCKET, *self.sort, HASH).write.mode("overwrite").options(**CODEC).parquet(path)
            return
        parts = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        slice_ = F.pmod(F.xxhash64(*[F.col(c) for c in own if not isinstance(ready.schema[c].dataType, T.MapType)]), F.lit(parts))
        laid = ready.repartition(BUCKET, slice_) if parts > 1 else ready.repartition(BUCKET)
        laid.sortWithinPartitions(BUCKET, *self.sort, HASH).write.mode("overwrite").partitionBy(BUCKET).options(**CODEC, **BLOOM).parquet(path)

    def append(self, rows: DataFrame, n: int, newest_s: int | None = None) -> None:
        """Adds the rows of batch ``n``, merges what is due and removes what neither this batch nor the next one reads.

        ``newest_s`` is the batch's newest second where other rows than these count, too."""
        self.put(rows, n)
        self.settle(rows.sparkSession, n, newest_s)

    def put(self, rows: DataFrame, n: int) -> DataFrame:
        """The first half of ``append``: writes the rows of batch ``n`` and gives them as they lie there, with their bucket, until
        ``settle``. The batches before ``n`` read as they did."""
        run = (0, n, n)
        self._write(rows.withColumn(BATCH, F.lit(n).cast("long")), run)
        schema = T.StructType([*rows.schema, T.StructField(BUCKET, T.IntegerType())])
        return rows.sparkSession.read.schema(schema).parquet(f"{self.path}/{self._name(run)}")

    def groups(self, spark: SparkSession, n: int, most_bytes: int) -> list[Column]:
        """Filters that cut what was put for batch ``n`` into groups of whole buckets, of about ``most_bytes`` of files each."""
        size = Folder(spark, self.path).size(self._name((0, n, n)))
        count = min(self.buckets, max(1, -(-size // most_bytes)))
        ends = [self.buckets * k // count for k in range(count + 1)]
        return [(F.col(BUCKET) >= a) & (F.col(BUCKET) < b) for a, b in zip(ends, ends[1:])]

    def split(self, rows: DataFrame, ids: Column) -> bool:
        """Whether rows with the same of ``ids`` (null: none) lie in several buckets."""
        both = rows.select(F.xxhash64(ids).alias("_id"), self._bucket(self._hash()).alias(BUCKET), ids.isNotNull().alias("_has")).filter("_has")
        return not both.groupBy("_id").agg(F.min(BUCKET).alias("a"), F.max(BUCKET).alias("b")).filter("a <> b").isEmpty()

    def settle(self, spark: SparkSession, n: int, newest_s: int | None = None) -> None:
        """The second half of ``append``: merges and removes."""
        folder = Folder(spark, self.path)
        if self.time:
            if newest_s is None:
                newest_s = self._read(spark, [self._name((0, n, n))]).agg(F.max(self.time)).first()[0]
            marks = [m for m in (self.mark(spark, n), newest_s) if m is not None]
            folder.create(f"_mark-{n}", str(max(marks)) if marks else "", replace=True)
        level = 1
        while (n + 1) % self.every**level == 0:
            size = self.every ** (level - 1)
            parts = [(level - 1, at, at + size - 1) for at in range(n + 1 - size * self.every, n + 1, size)]
            held = self._fresh(spark, self._read(spark, self._live(folder, parts)), n + 1)
            if held is not None:
                merged = self.merge(held.drop(HASH, BUCKET))
                if self.oldest and parts[0][1] == 0 and (mark := self.mark(spark, n + 1)) is not None:
                    merged = self.oldest(merged, self.time, mark)
                self._write(merged, (level, parts[0][1], n))
                if self.time:
                    folder.create(f"_newest-{level}-{parts[0][1]}-{n}", str(self.mark(spark, n + 1) or ""), replace=True)
            level += 1
        self._tidy(spark, folder, n)

    def _tidy(self, spark: SparkSession, folder: Folder, n: int) -> None:
        needed = {self._name(run) for run in self.cover(n) + self.cover(n + 1)}
        passed = None
        if self.keep_s is not None and (mark := self.mark(spark, n)) is not None:
            passed = mark - self.keep_s
        for name in folder.names():
            if name.startswith("run="):
                # All rows of a merged run are at most as new as the mark when it was made.
                made = folder.text(f"_newest-{name[4:]}") if passed is not None else None
                if name not in needed or made and int(made) < passed:
                    folder.remove(name)
            elif name.startswith("_newest-") and f"run={name[8:]}" not in needed or name.startswith("_mark-") and int(name[6:]) < n - 1:
                folder.remove(name)
