"""Importance resampling towards a target's word distribution, with exact ranks from parallel sorting by regular sampling.

Features are runs of one to ``width`` consecutive words; each falls into one of ``buckets`` by its crc32. A bucket's gain compares
its smoothed shares in the target and in the source, a document's weight adds up the gains of its features, and Gumbel noise from a
hash of the id turns the largest scores into a draw without replacement.

The draw sorts in parallel by regular sampling: every scan partition is sorted as a run, rows at regular places of the runs give
splitters, each run's segments go to the partition of their splitter and are merged there, and the counts of the segments before it
tell a partition its first rank. Only segments that can hold a drawn row are exchanged. A place in its run is the last part of a row's key, so equal rows
(a third of the table, if it must be) spread over several segments and every rank is given once.

To the driver come ``buckets`` sums, at most ``MAX_SEGMENTS * SAMPLES`` sampled keys with one more for each run, and a count for each
segment; neither grows with the documents' texts.

Null texts have no features and weight 0; a null id is hashed as empty text and comes last among equal scores. Repeated rows are
drawn as documents of their own. An empty table gives an empty result, an empty target equal treatment of unseen buckets. Other
columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NOT_ALNUM, joined, partitions, sums_by_doc, text_bytes, text_chunks, word_spans, written

#: Segments of a sort, and sampled keys for each of them.
MAX_SEGMENTS, SAMPLES = 1024, 128
#: Bytes of a word that all words take together; the rest of longer ones goes word by word.
_TOGETHER = 48

_KEY = ("late", "loss", "id_last", "id", "run", "place")
_ROW = "doc_id long, n_words long, n_features long, weight long, score long"
_RUN = f"{_ROW}, late long, loss long, id_last long, id long, run long, place long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _crc_after(state: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc registers ``state`` after the bytes of each span."""
    order = np.argsort(starts - ends, kind="stable")
    sizes, at, value = (ends - starts)[order], starts[order], state[order]
    # Longest spans first: those with a byte at place k are the first ones.
    for k in range(min(int(sizes[0]), _TOGETHER) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, side="left"))
        value[:n] = _CRC[(value[:n] ^ buffer[at[:n] + k]) & np.uint32(0xFF)] ^ (value[:n] >> np.uint32(8))
    for k in range(int(np.searchsorted(-sizes, -_TOGETHER, side="left"))):
        rest = buffer[at[k] + _TOGETHER : at[k] + sizes[k]].tobytes()
        value[k] = zlib.crc32(rest, int(value[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(value)
    out[order] = value
    return out


def _features(texts: list[bytes], width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature of the texts, and the words of each text."""
    buffer, begins = joined(texts)
    buffer = LOWER[buffer]
    starts, ends = word_spans(buffer, NOT_ALNUM)
    doc = np.searchsorted(begins, starts, side="right") - 1
    docs, found = [], []
    state = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(width):
        # The registers of runs of k words go on with a space and the word behind them, in the same document.
        n = max(0, len(starts) - k)
        same = np.flatnonzero(doc[:n] == doc[k:])
        if k:
            gap = _CRC[(state[same] ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state[same] >> np.uint32(8))
        else:
            gap = state
        state = np.zeros(len(starts), dtype=np.uint32)
        state[same] = _crc_after(gap, buffer, starts[same + k], ends[same + k])
        docs.append(doc[same])
        found.append((state[same] ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets)
    return np.concatenate(docs), np.concatenate(found), np.bincount(doc, minlength=len(texts))


def _texts(table: DataFrame, *others: str) -> DataFrame:
    return table.select(*[F.col(c).cast("long").alias(c) for c in others], F.col("text").cast("string").alias("text"))


def bucket_counts(table: DataFrame, width: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features in each bucket over all texts of ``table``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in text_chunks(batches):
            total += np.bincount(_features(text_bytes(batch["text"]), width, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in _texts(table).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, one added to each count."""
    all_source, all_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratios = (target + 1.0) * all_source / ((source + 1.0) * all_target)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], dtype=np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, width: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            doc, bucket, n_words = _features(text_bytes(batch["text"]), width, len(gain))
            n = np.bincount(doc, minlength=batch.num_rows)
            weight = sums_by_doc(gain[bucket], doc, batch.num_rows).astype(np.int64)
            arrays = [batch["doc_id"], *map(pa.array, (n_words, n, weight))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    return _texts(docs, "doc_id").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int) -> Column:
    """Thousandths of a Gumbel value that hangs on seed and id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform)))


# --- parallel sorting by regular sampling ----------------------------------------------------------


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a run with the run's number and their place in it."""
    run, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        where = [pa.array(np.full(n, run, dtype=np.int64)), pa.array(np.arange(place, place + n, dtype=np.int64))]
        place += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *where], names=[*batch.schema.names, "run", "place"])


def _splitters(runs: DataFrame, n_rows: int, segments: int) -> list[np.ndarray]:
    """Key columns of the rows that begin the second and later segments, from keys at regular places of every run."""
    step = max(1, n_rows // (segments * SAMPLES))
    sample = runs.filter(F.col("place") % step == step // 2).select(*_KEY).toArrow()
    columns = [sample[c].to_numpy().astype(np.int64) for c in _KEY]
    order = np.lexsort(columns[::-1])
    at = order[np.arange(1, segments) * len(order) // segments] if len(order) else order
    return [c[at] for c in columns]


def _segments(splitters: list[np.ndarray]):
    """Adds to each row the number of splitters that are not behind it."""
    n = len(splitters[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.concatenate([s, batch[c].to_numpy().astype(np.int64)]) for s, c in zip(splitters, _KEY)]
            order = np.lexsort(keys[::-1])
            segment = np.empty(len(order), dtype=np.int64)
            segment[order] = np.cumsum(order < n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment[n:])], names=[*batch.schema.names, "segment"])

    return run


def _merged(starts: list[int], drawn: int):
    """Ranks of the sorted rows of a segment, which follow those of the segments before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            rank = np.array(starts, dtype=np.int64)[batch["segment"].to_numpy()] + np.arange(seen + 1, seen + batch.num_rows + 1)
            seen += batch.num_rows
            names = [x.split()[0] for x in _ROW.split(", ")]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(rank, mask=rank > drawn)], names=[*names, "rank"])

    return run


def ranked(rows: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``rows`` (doc_id, n_words, n_features, weight, score) and ``rank``: 1, 2, 3... by falling score and rising id, null behind
    ``percent`` of the rows with at least ``least_words`` words, rounded down, and in rows with fewer words."""
    late = (F.col("n_words") < least_words).cast("long")
    keyed = rows.withColumns({
        "late": late, "loss": -F.col("score"), "id_last": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0).cast("long")),
    })
    ordered = keyed.sortWithinPartitions("late", "loss", "id_last", "id", "weight", "n_features")
    runs = written(ordered.mapInArrow(_numbered, _RUN), "runs")
    counted = {late: n for late, n in runs.groupBy("late").count().collect()}
    drawn = percent * counted.get(0, 0) // 100
    n_segments = min(partitions(rows.sparkSession), MAX_SEGMENTS)
    splitters = _splitters(runs, sum(counted.values()), n_segments)
    placed = written(runs.mapInArrow(_segments(splitters), f"{_RUN}, segment long"), "segments")
    sizes = np.zeros(n_segments, dtype=np.int64)
    for segment, n in placed.groupBy("segment").count().collect():
        sizes[segment] = n
    starts = np.cumsum(sizes) - sizes
    last = int(np.searchsorted(starts, drawn, side="left"))
    first = placed.filter(F.col("segment") < last).repartitionById(max(1, last), F.col("segment").cast("int"))
    merged = first.sortWithinPartitions(*_KEY).mapInArrow(_merged(starts.tolist(), drawn), f"{_ROW}, rank long")
    names = [x.split()[0] for x in _ROW.split(", ")]
    rest = placed.filter(F.col("segment") >= last).select(*names, F.lit(None).cast("long").alias("rank"))
    return merged.unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, width: int = 1, buckets: int = 10_000, seed: int = 2024
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); ``target`` has a text column.

    ``percent`` of the rows with at least ``least_words`` words are drawn, rounded down.
    """
    gain = gains(bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets))
    scored = weighted(docs, gain, width).withColumn("score", F.col("weight") + noise("doc_id", seed))
    return ranked(scored, percent, least_words)


def drawn_documents(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """All columns of the rows of ``docs`` whose id ``resample`` has drawn; rows that share a drawn id come with it."""
    ids = ranks.filter("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("_drawn")), "left_semi")
