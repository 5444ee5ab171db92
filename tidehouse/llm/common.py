"""Helpers the training-data operators share: written tables, batches of bounded size, words as numpy spans."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir

#: White space of the word contracts: the bytes 20 and 09 to 0D (fixed values).
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything but ASCII letters, digits and bytes of other characters (fixed values).
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[0x30:0x3A] = NOT_ALNUM[0x41:0x5B] = NOT_ALNUM[0x61:0x7B] = NOT_ALNUM[0x80:] = False
#: Lower-casing of A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(1 << 16, 0xD6E8FEB86659FD93, dtype=np.uint64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe when an executor is lost."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished jobs, which it does when the driver's garbage is collected.

    For steps that leave as much on the executors' disks as their input has, before the next step adds its own.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_HELD: dict[str, object] = {}


def held(key: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the Python worker for its next tasks until something else is to be kept.

    Workers are used again by later stages and operators; only one thing stays, so their memory does not add up.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """Partitions of an own ``repartition``: the session's number, which follows the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row; memory follows neither batch nor table."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each followed by ``gap``; and where each begins, with the end as last entry."""
    buffer = np.frombuffer(gap.join(texts) + gap, dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) + len(gap) for x in texts], out=begins[1:])
    return buffer, begins


def word_spans(buffer: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no separators."""
    inside = np.empty(len(buffer) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~separators[buffer]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each span's bytes; tells the distinct spans of a chunk apart."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(first, sizes)
    value = buffer[np.repeat(starts, sizes) + place].astype(np.uint64) + np.uint64(1)
    value *= _POWERS[place & 0xFFFF]
    if int(sizes.max()) > 1 << 16:
        value *= (place >> 16).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    value ^= value >> np.uint64(29)
    out = np.add.reduceat(value, first)
    out = (out ^ (out >> np.uint64(32))) * _MULTIPLIER
    return out ^ (out >> np.uint64(29)) ^ sizes.astype(np.uint64)


def distinct_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, with_hashes: bool = False) -> tuple:
    """(position of one span of each distinct word, for each span the number of its distinct word[, their hashes])."""
    hashes, first, inverse = np.unique(span_hashes(buffer, starts, ends), return_index=True, return_inverse=True)
    return (first, inverse.reshape(-1), hashes) if with_hashes else (first, inverse.reshape(-1))


def sums_by_doc(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n_docs)
