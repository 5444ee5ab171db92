"""Context-triggered piecewise hashing: fingerprints that stay alike where texts do.

A rolling hash of the last seven bytes ends a chunk wherever its lowest k bits are all ones, so chunks end at the same places in
alike passages. The block size 2^k is the largest (from 4 on) at which a text has 32 ends. A chunk gives one of 64 characters by
the sum of its rolling hashes; a signature has at most 64 characters, the last one for all that is left. The fingerprint is
``size:signature:signature at twice the size``.

Likeness of two fingerprints: 1 - edit distance / longer length of the signatures at a common block size, the larger one if there
are two; 0 without a common size, or if both signatures have seven characters or more and share no seven in a row.

Null texts count as empty (``4::``); two empty texts have likeness 1, an empty and another one 0. Rows with null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, text_chunks, written

WINDOW = 7
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_FACTORS = [np.uint32(pow(0x01000193, j, 1 << 32)) for j in range(WINDOW)]


def fingerprint(text: bytes, ends: int = 32, longest: int = 64) -> str:
    if not text:
        return "4::"
    b = np.frombuffer(text, dtype=np.uint8).astype(np.uint32) + np.uint32(1)
    rolling = b.copy()
    for j in range(1, min(WINDOW, len(b))):
        rolling[j:] += b[:-j] * _FACTORS[j]
    rolling ^= rolling >> np.uint32(15)
    rolling *= np.uint32(0x2C1B3C6D)
    rolling ^= rolling >> np.uint32(13)
    total = np.cumsum(rolling, dtype=np.uint64)
    places = np.flatnonzero((rolling & np.uint32(3)) == 3)
    marks = rolling[places]
    k = 2
    levels = [places]
    while True:
        k += 1
        mask = np.uint32((1 << min(k, 31)) - 1)
        keep = (marks & mask) == mask
        places, marks = places[keep], marks[keep]
        levels.append(places)
        if len(places) < ends or k == 31:
            break
    # The last level fell short of the ends wanted, unless even the first one did.
    level = max(0, len(levels) - 2)
    if level + 1 == len(levels):
        levels.append(places[:0])
    signatures = [_signature(total, levels[level + i], longest) for i in (0, 1)]
    return f"{4 << level}:{signatures[0]}:{signatures[1]}"


def _signature(total: np.ndarray, places: np.ndarray, longest: int) -> str:
    places = places[: longest - 1]
    if not len(places) or places[-1] != len(total) - 1:
        places = np.append(places, len(total) - 1)
    sums = np.diff(total[places], prepend=np.uint64(0))
    return _ALPHABET[(sums * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)].tobytes().decode()


def likeness(a: str | Column, b: str | Column) -> Column:
    """Likeness of two fingerprint columns, 0 to 1."""
    left, right = F.split(a, ":"), F.split(b, ":")
    a0, a1, a2 = left[0].cast("long"), left[1], left[2]
    b0, b1, b2 = right[0].cast("long"), right[1], right[2]
    return (
        F.when(F.col(a) == F.col(b), F.lit(1.0))
        .when((a1 == "") | (b1 == ""), F.lit(0.0))
        .when(a0 == b0, F.greatest(_alike(a1, b1), _alike(a2, b2)))
        .when(a0 == 2 * b0, _alike(a1, b2))
        .when(b0 == 2 * a0, _alike(a2, b1))
        .otherwise(F.lit(0.0))
    )


def _alike(x: Column, y: Column) -> Column:
    length = F.greatest(F.length(x), F.length(y))
    short = F.least(F.length(x), F.length(y)) < WINDOW
    runs = F.transform(F.sequence(F.lit(1), F.length(x) - (WINDOW - 1)), lambda i: F.substring(x, i, F.lit(WINDOW)))
    shared = F.when(short, F.lit(True)).otherwise(F.exists(runs, lambda r: F.contains(y, r)))
    return F.when(shared, 1 - F.levenshtein(x, y) / length).otherwise(F.lit(0.0))


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string, "
    "kind int, part long, text string"
)
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()]
_ROW, _FIRST, _LAST = 0, 1, 2


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)


def _row(doc_id: int | None, text: str, own: str, following: str, its: str) -> tuple:
    tail = len(text) // 3
    edited = (text[: len(text) - tail] + following[:tail]).encode()
    digest = hashlib.sha256(edited).hexdigest()
    return doc_id, len(text), digest, own, fingerprint(edited), its, _ROW, None, None


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished rows of a sorted partition; its first text and its last row, for its neighbours, besides."""
    part = TaskContext.get().partitionId()
    before = None
    for batch in text_chunks(batches):
        out = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            own = fingerprint(text.encode())
            if before:
                out.append(_row(*before, text, own))
            else:
                out.append((None, None, None, own, None, None, _FIRST, part, text))
            before = doc_id, text, own
        if out:
            yield _batch(out)
    if before:
        yield _batch([(before[0], None, None, before[2], None, None, _LAST, part, before[1])])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_row(*(r[c] for c in ("doc_id", "text", "own", "following", "its"))) for r in batch.to_pylist()]
        if rows:
            yield _batch(rows)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller doc_id, after the last the first; repeated ids are ordered by text.
    One sort deals the texts to partitions; only each partition's first and last row are matched up afterwards.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    order = [F.desc_nulls_last("doc_id"), F.desc("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    made = written(rows.select("doc_id", "text").mapInArrow(_stream, _SCHEMA), "piecewise")

    first = made.filter(f"kind = {_FIRST}").select(F.col("part").alias("next_part"), F.col("text").alias("following"), F.col("fingerprint").alias("its"))
    last = made.filter(f"kind = {_LAST}").select("part", "doc_id", "text", F.col("fingerprint").alias("own"))
    # One row for each partition of the sort.
    after = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(0))))
    parts = last.select("part", after.alias("next_part"))
    ends = last.join(parts, "part").join(first, "next_part").select("doc_id", "text", "own", "following", "its")
    whole = made.filter(f"kind = {_ROW}").unionByName(ends.mapInArrow(_finish, _SCHEMA))
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
