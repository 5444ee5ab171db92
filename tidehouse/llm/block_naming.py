"""Exact deduplication by naming: equal blocks get equal integers, adjacent integers are named again until one is left.

A text (null counts as empty) is lower-cased in A-Z and cut into blocks of ``block_bytes`` bytes. Sorting all blocks gives each
distinct content its integer: its place in the sort. Then adjacent pairs of integers are sorted and named in the same way, level
by level; a document leaves when one integer is left, and (level, integer) is equal for two documents if and only if their
texts are. Contents are compared, not only hashes: the hash merely orders the sort, so its sampled bounds stay small.

Hot contents: the sort orders by (hash, row), so copies of one block spread over as many partitions as they need. Contents that
touch a partition's edge, at most a few for each partition, take the name they have in the earliest one; only rows at the
beginning of a partition can need that, and only they are joined.
Rows with null ids and repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, text_bytes, text_chunks, written

_CARRIED = "row long, doc_id long, sha string, pos long, last long"
_BLOCKS = f"{_CARRIED}, hash long, content binary"
_NAMED = f"{_CARRIED}, part long, rank long, edge boolean, content binary"


def _cut(block_bytes: int):
    """Rows of blocks; the first block of a document also carries its id and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            out: list[list] = [[] for _ in range(7)]
            for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), text_bytes(batch["text"])):
                text = text.lower()
                last = max(0, len(text) - 1) // block_bytes
                for pos in range(last + 1):
                    block = text[pos * block_bytes : (pos + 1) * block_bytes]
                    digest = None if pos else hashlib.sha256(text).hexdigest()
                    for column, value in zip(out, (row, None if pos else doc_id, digest, pos, last, _signed(block), block)):
                        column.append(value)
            yield _batch(out, _BLOCKS)

    return run


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    """Arrow columns, or lists, under the names and types of a Spark schema."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _signed(block: bytes) -> int:
    value = xxhash.xxh64_intdigest(block)
    return value - (1 << 64) if value >> 63 else value


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of the distinct contents of a sorted partition, and the contents of its first and last hash.

    Rows of one hash come by row, not by content, so the (nearly always one) contents of the hash at hand are kept.
    """
    part = TaskContext.get().partitionId()
    rank, now, known, first = -1, None, {}, True
    for batch in batches:
        ranks, at_edge, edges = [], [], []
        for value, content in zip(batch["hash"].to_pylist(), batch["content"].to_pylist()):
            if value != now or not known:
                if first and known:
                    first = False
                    edges += known.items()
                now, known = value, {}
            if content not in known:
                rank += 1
                known[content] = rank
            ranks.append(known[content])
            at_edge.append(first)
        n = batch.num_rows
        carried = [batch[x.split()[0]] for x in _CARRIED.split(", ")]
        yield _batch([*carried, [part] * n, ranks, at_edge, [None] * n], _NAMED)
        yield _edges(part, edges)
    yield _edges(part, list(known.items()))


def _edges(part: int, contents: list) -> pa.RecordBatch:
    n = len(contents)
    return _batch([[None] * n] * 5 + [[part] * n, [r for _, r in contents], [True] * n, [c for c, _ in contents]], _NAMED)


def _names(blocks: DataFrame, label: str) -> DataFrame:
    """The carried columns and ``name``: one integer for each distinct content."""
    n = partitions(blocks.sparkSession)
    ordered = blocks.repartitionByRange(n, "hash", "row", "pos").sortWithinPartitions("hash", "row", "pos")
    ranked = written(ordered.mapInArrow(_rank, _NAMED), label)
    edges = ranked.filter("content IS NOT NULL").select("part", "rank", "content")
    smallest = edges.groupBy("content").agg(F.min(F.struct("part", "rank")).alias("to"))
    renamed = edges.join(smallest, "content").select("part", "rank", "to").filter("to.part <> part OR to.rank <> rank")
    # 2^40 contents for each partition of a sort.
    carried = [x.split()[0] for x in _CARRIED.split(", ")]
    rows = ranked.filter("content IS NULL")
    inner = rows.filter("NOT edge").select(*carried, _name(F.col("part"), F.col("rank")))
    edge = rows.filter("edge").join(renamed, ["part", "rank"], "left")
    return inner.unionByName(edge.select(*carried, _name(F.coalesce("to.part", "part"), F.coalesce("to.rank", "rank"))))


def _name(part: Column, rank: Column) -> Column:
    return (part * F.lit(1 << 40) + rank).alias("name")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content and hash of a pair of names."""
    for batch in batches:
        content = [struct.pack(">qq", a, b) for a, b in zip(batch["left"].to_pylist(), batch["right"].to_pylist())]
        carried = [batch[x.split()[0]] for x in _CARRIED.split(", ")]
        yield _batch([*carried, [_signed(c) for c in content], content], _BLOCKS)


def identities(docs: DataFrame, block_bytes: int = 2048) -> DataFrame:
    """(row, doc_id, sha, level, name) for each row of ``docs`` (doc_id, text); equal (level, name): equal texts."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
    )
    named = _names(rows.mapInArrow(_cut(block_bytes), _BLOCKS), "names")
    longest = named.agg(F.max("last")).first()[0] or 0
    done = None
    for level in range(longest.bit_length() + 1):
        ended = named.filter("last = 0").select("row", "doc_id", "sha", F.lit(level).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        if level == longest.bit_length():
            return done
        pairs = named.filter("last > 0").groupBy("row", F.expr("pos div 2").alias("pos")).agg(
            F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"), F.expr("max(last) div 2").alias("last"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        pairs = pairs.select("row", "doc_id", "sha", "pos", "last", "left", "right")
        named = _names(written(pairs.mapInArrow(_pairs, _BLOCKS), "pairs"), "names")


def exact_duplicates(docs: DataFrame, block_bytes: int = 2048) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest doc_id stays (null ids are smallest); of repeated rows of that id one is marked as kept.
    """
    rows = identities(docs, block_bytes)
    groups = rows.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    out = rows.join(groups, ["level", "name"])
    kept = F.col("row") == F.col("keep.row")
    return out.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
