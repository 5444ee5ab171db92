"""Prefix trie of conversations: padded matrices of turn ids, sorted and reduced in numpy shard by shard, joined at the shards' edges.

A turn's id is 120 bits of a digest of role and text, so texts are never shuffled. Conversations are dealt to shards by range of their
id sequences and, of equal sequences, of their own ids; thus a first turn or whole conversation that a third of all rows share is
spread over as many shards as it needs. Inside a shard sequences become a matrix padded with -1, a few columns at a time for the rows
that go on, ordered by ``lexsort``; where a column differs from the row above, or-accumulated over the columns, a node starts, and
``reduceat`` aggregates each depth.

Only nodes on the path of a shard's first or last row can go on in a neighbouring shard. They are partial rows: equal beginnings of a
shard's last and the next one's first sequence tell which of them are one node. Sums then add up; a child, a leaf or a text that
both sides counted is taken out again. Ids of conversations that end in such a node are packed by the thousand and hashed as a stream
in their order, so no list of them is ever held.

A null turn number comes first, equal numbers go by the turns' ids; null roles and texts count as empty. Rows with a null conv_id are
one conversation, last among equal ones and of smallest id only where it is alone; its id is written as empty text. Repeated rows are
turns of their own. An empty table has no nodes. A conversation is one value and a shard's ids are held by one task, so the number of
shards follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written

#: Columns of a matrix; rows that go on are sorted again by the next ones.
STRIPE = 16
#: Ids of a piece of a shared node's list.
PIECE = 4096

INNER, PATH, ENDS = 0, 1, 2
FIRST, LAST = 0, 1
NO_ENDS = hashlib.sha256(b"").hexdigest()

_PARTS = (
    "kind int, shard long, side int, depth long, conv_id long, parent_conv_id long, parent_side int, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, hi long, lo long, bytes long, before long, shared boolean, last_depth long, "
    "piece long, ids string"
)
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
_FIELDS = [(name, _TYPES[kind]) for name, kind in (x.split() for x in _PARTS.split(", "))]
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _turn() -> Column:
    """(turn, hi, lo, bytes): the number first, then two parts of the digest, then the text's length."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    hi, lo = (F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16))
    return F.struct(F.col("turn").cast("long").alias("turn"), hi.alias("hi"), lo.alias("lo"), F.octet_length(text).cast("long").alias("bytes"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of ``conversations`` (conv_id, turn, role, text); turns are ids in order, with their text's bytes."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), _turn().alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["bytes"].alias("bytes"))).alias("turns"))


def with_shared_starts(rows: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversations as branches of the first one of their group of ``group`` ids: its first h turns, then their own behind their
    first h, where h is the crc32 of the id modulo ``most``. Without that first one, the own turns behind h are left."""
    c = F.col("conv_id")
    h = (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % most).cast("int")
    based = rows.withColumns({"base": c - c % group, "h": h})
    start = F.max(F.when(c == F.col("base"), F.slice("turns", 1, most - 1))).over(Window.partitionBy("base"))
    none = F.slice("turns", 1, 0)
    kept = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    started = based.withColumn("start", F.coalesce(start, none))
    return started.select("conv_id", F.concat(F.slice("start", F.lit(1), F.col("h")), kept).alias("turns"))


# --- one shard -----------------------------------------------------------------------------------


class _Shard:
    """Conversations of one shard as arrays: ids of all turns behind each other, ``offsets`` of the rows, numbers of the turns."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches)
        conv, turns = table["conv_id"].combine_chunks(), table["turns"].combine_chunks()
        self.null = conv.is_null().to_numpy(zero_copy_only=False)
        self.conv = pc.fill_null(conv, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        self.length = pc.list_value_length(turns).to_numpy(zero_copy_only=False).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.length)])
        flat = turns.flatten()
        self.hi, self.lo, self.bytes = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        # Numbers in the order of the ids, as the range partitioning has it.
        order = np.lexsort((self.lo, self.hi))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.hi[order][1:] != self.hi[order][:-1]) | (self.lo[order][1:] != self.lo[order][:-1])
        self.ids = np.empty(len(order), dtype=np.int64)
        self.ids[order] = np.cumsum(new) - 1

    def matrix(self, rows: np.ndarray, at: int) -> np.ndarray:
        """Columns ``at`` and following of the padded matrix."""
        place = at + np.arange(STRIPE)
        inside = place < self.length[rows][:, None]
        return np.where(inside, self.ids[np.where(inside, self.offsets[rows][:, None] + place, 0)], -1)

    def grow(self) -> None:
        """All nodes as columns, parents before children, and the rows in order."""
        n = len(self.conv)
        node = np.zeros(n, dtype=np.int64)  # of each row, the deepest so far
        levels = [(np.full(1, -1), np.full(1, n), np.full(1, self.conv.min()), np.full(1, self.null.sum()), np.zeros(1, dtype=np.int64))]
        count = 1
        # As in every stripe below, sequences that end come before those that go on.
        order, group = np.lexsort((self.conv, self.null, self.length > 0)), np.zeros(n, dtype=np.int64)
        for at in range(0, int(self.length.max()), STRIPE):
            places = np.flatnonzero(self.length[order] > at)
            rows, old = order[places], group[places]
            cells = self.matrix(rows, at)
            # A sequence that ends with the stripe comes before those that go on; equal ones stay in the order of their ids.
            goes_on = self.length[rows] > at + STRIPE
            moved = np.lexsort((goes_on, *cells.T[::-1], old))
            rows, cells, old = rows[moved], cells[moved], old[moved]
            order[places] = rows
            change = np.ones(cells.shape, dtype=bool)
            change[1:] = cells[1:] != cells[:-1]
            change[1:, 0] |= old[1:] != old[:-1]
            starts_node = np.logical_or.accumulate(change, axis=1)
            group[places] = np.cumsum(starts_node[:, -1])
            for k in range(STRIPE):
                inside = np.flatnonzero(cells[:, k] >= 0)
                if not len(inside):
                    break
                here, first = rows[inside], np.flatnonzero(starts_node[inside, k])
                sizes = np.diff(np.append(first, len(here)))
                turn = self.offsets[here[first]] + at + k
                levels.append((
                    node[here[first]], sizes, np.minimum.reduceat(self.conv[here], first), np.add.reduceat(self.null[here].astype(np.int64), first), turn,
                ))
                node[here] = np.repeat(np.arange(count, count + len(first)), sizes)
                count += len(first)
        self.order, self.end = order, node
        self.parent, self.n, self.low, self.n_null, self.turn = (np.concatenate(x) for x in zip(*levels))
        self.depth = np.repeat(np.arange(len(levels)), [len(x[0]) for x in levels])
        self.size = np.where(self.depth > 0, self.bytes[self.turn] if len(self.bytes) else 0, 0)
        self.children = np.bincount(self.parent[1:], minlength=count)
        self.leaves = (self.children == 0).astype(np.int64)
        self.saved = (self.n - 1) * self.size
        edges = np.searchsorted(self.depth, np.arange(len(levels) + 1))
        for k in range(len(levels) - 1, 0, -1):
            level = slice(edges[k], edges[k + 1])
            np.add.at(self.leaves, self.parent[level], self.leaves[level])
            np.add.at(self.saved, self.parent[level], self.saved[level])

    def path(self, row: int) -> np.ndarray:
        """Nodes from the root to the end of a row."""
        found, k = [], int(self.end[row])
        while k >= 0:
            found.append(k)
            k = int(self.parent[k])
        return np.array(found[::-1])

    def decimals(self, rows: np.ndarray) -> list[str]:
        return ["" if null else str(c) for c, null in zip(self.conv[rows].tolist(), self.null[rows].tolist())]


def _batch(n: int, **columns) -> pa.RecordBatch:
    """The given columns, arrays or one value for all rows; the others are null."""
    arrays = []
    for name, kind in _FIELDS:
        value = columns.get(name)
        arrays.append(pa.array(value, kind) if isinstance(value, (np.ndarray, list)) else value if isinstance(value, pa.Array) else pa.repeat(pa.scalar(value, kind), n))
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _FIELDS])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard; those on its first or last path, with pieces of their ends, are partial."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    shard, number = _Shard(held), TaskContext.get().partitionId()
    shard.grow()
    first, last = shard.path(shard.order[0]), shard.path(shard.order[-1])
    count = len(shard.parent)
    side = np.full(count, -1, dtype=np.int32)
    side[last], side[first] = LAST, FIRST
    on_path = side >= 0
    shared = np.zeros(count, dtype=bool)
    shared[np.intersect1d(first, last)] = True
    before = np.zeros(count, dtype=np.int64)
    before[first] = np.cumsum(shard.size[first])
    # Ends: rows of one end are next to each other, and rise by id.
    digests, pieces = np.full(count, NO_ENDS, dtype=object), []
    ended = shard.end[shard.order]
    starts = np.flatnonzero(np.append(True, ended[1:] != ended[:-1]))
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(ended)).tolist()):
        k = int(ended[a])
        if on_path[k]:
            pieces += [(int(side[k]), int(shard.depth[k]), p, ",".join(shard.decimals(shard.order[p : min(p + PIECE, b)]))) for p in range(a, b, PIECE)]
        else:
            digests[k] = hashlib.sha256(",".join(shard.decimals(shard.order[a:b])).encode()).hexdigest()
    digests[on_path] = None
    up = np.maximum(shard.parent, 0)
    parent_side = np.where(shard.parent >= 0, side[up], -1).astype(np.int32)
    alone = shard.n_null == shard.n
    has_turn = shard.depth > 0
    turn = np.where(has_turn, shard.turn, 0) if len(shard.hi) else None
    hi, lo = ((x[turn] if turn is not None else np.zeros(count, dtype=np.int64)) for x in (shard.hi, shard.lo))
    step = 1 << 16
    for a in range(0, count, step):
        part = slice(a, a + step)
        yield _batch(
            len(shard.parent[part]), kind=on_path[part].astype(np.int32), shard=number, side=side[part], depth=shard.depth[part],
            conv_id=pa.array(shard.low[part], mask=alone[part]),
            parent_conv_id=pa.array(shard.low[up[part]], mask=alone[up[part]] | (shard.parent[part] < 0) | (parent_side[part] >= 0)),
            parent_side=parent_side[part], n_convs=shard.n[part], n_children=shard.children[part], n_leaves=shard.leaves[part],
            saved_tokens=shard.saved[part], ends_sha256=digests[part].tolist(), hi=hi[part], lo=lo[part], bytes=shard.size[part],
            before=before[part], shared=shared[part], last_depth=len(last) - 1,
        )
    sides, depths, places, ids = ([x[k] for x in pieces] for k in range(4))
    yield _batch(len(pieces), kind=ENDS, shard=number, side=sides, depth=depths, piece=places, ids=ids)


# --- edges of the shards ---------------------------------------------------------------------------


def _meetings(paths: DataFrame) -> DataFrame:
    """(shard, met, met_before, met_after): turns that a shard's first sequence has in common with the last one of the shard before it
    (-1 for the first shard), their bytes, and the same count towards the shard after it. One row for each shard with rows."""
    by_shard = Window.orderBy("shard")
    shards = paths.filter("depth = 0").select("shard", F.lag("shard").over(by_shard).alias("previous"))
    firsts = paths.filter((F.col("side") == FIRST) & (F.col("depth") > 0)).select("shard", "depth", "hi", "lo").join(shards, "shard")
    lasts = paths.filter("side = 1 OR shared").select(
        F.col("shard").alias("previous"), "depth", F.col("hi").alias("last_hi"), F.col("lo").alias("last_lo")
    )
    same = F.coalesce((F.col("hi") == F.col("last_hi")) & (F.col("lo") == F.col("last_lo")), F.lit(False))
    compared = firsts.join(lasts, ["previous", "depth"], "left").groupBy("shard").agg(
        F.coalesce(F.min(F.when(~same, F.col("depth"))) - 1, F.max("depth")).alias("met")
    )
    met = shards.join(compared, "shard", "left").select(
        "shard", F.when(F.col("previous").isNull(), -1).otherwise(F.coalesce("met", F.lit(0))).cast("long").alias("met")
    )
    sizes = paths.filter(F.col("side") == FIRST).select("shard", F.col("depth").alias("met"), F.col("before").alias("met_before"))
    return met.join(sizes, ["shard", "met"], "left").withColumn("met_after", F.lead("met").over(by_shard))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node of sorted pieces, as a stream."""
    node, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for depth, number, ids in zip(*(batch[c].to_pylist() for c in ("depth", "number", "ids"))):
            if (depth, number) == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, number), hashlib.sha256()
            digest.update(ids.encode())
        yield _digests(done)
    if node is not None:
        yield _digests([(*node, digest.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"depth": pa.int64(), "number": pa.int64(), "sha": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of ``rows`` (conv_id, turns) of ``sequences``: one row for each distinct sequence of first turns, the root among them.

    conv_id (the smallest member, which with the depth names the node), depth, parent_conv_id, n_convs, n_children, n_leaves (of its
    subtree), saved_tokens (of its subtree: bytes of a node's last text times its members but one) and ends_sha256 (members that end here).
    """
    shards = partitions(rows.sparkSession)
    dealt = written(rows, "sequences").repartitionByRange(shards, F.col("turns"), F.col("conv_id").asc_nulls_last())
    parts = written(dealt.mapInArrow(_nodes, _PARTS), "nodes")
    found = parts.filter(F.col("kind") == PATH)
    goes_on = (F.col("side") == FIRST) & (F.col("depth") <= F.col("met"))
    along = Window.partitionBy("depth").orderBy("shard", "side")
    # Along a depth, rows that go on belong to the node that the last row before them has begun.
    numbered = found.join(_meetings(found), "shard").withColumn("number", F.sum(F.when(goes_on, 0).otherwise(1)).over(along))
    leaf_again = ((F.col("side") == LAST) | F.col("shared")) & (F.col("met_after") >= F.col("last_depth"))
    child_again = (F.col("side") == FIRST) & (F.col("depth") < F.col("met"))
    paths = written(numbered.select(
        "shard", "side", "depth", "number", "conv_id", "parent_side", "n_convs",
        (F.col("n_children") - F.when(child_again, 1).otherwise(0)).alias("n_children"),
        (F.col("n_leaves") - F.when(leaf_again, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + F.when(goes_on, F.col("met_before") - F.col("before") + F.col("bytes")).otherwise(0)).alias("saved_tokens"),
    ), "paths")
    key = ["depth", "number"]
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    begun = F.min(F.struct("shard", "side", "parent_side"))
    whole = paths.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), *sums, begun.alias("begun"))
    place = ["shard", "side", "depth"]
    pieces = parts.filter(F.col("kind") == ENDS).select(*place, "piece", "ids").join(paths.select(*place, "number"), place)
    # "side" is no part of the order: a shard has one node of a depth and number.
    digests = pieces.repartition(*key).sortWithinPartitions(*key, "shard", "piece").mapInArrow(_hashed, "depth long, number long, sha string")
    ids = paths.select(*place, "number").join(whole.select(*key, "conv_id"), key)
    parents = ids.select(
        "shard", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent")
    )
    parent_key = ["shard", "parent_side", "depth"]
    shared = whole.select("*", "begun.shard", "begun.parent_side").join(digests, key, "left").join(parents, parent_key, "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    inner = parts.filter(F.col("kind") == INNER)
    below = inner.filter("parent_side >= 0").drop("parent_conv_id").join(parents.withColumnRenamed("parent", "parent_conv_id"), parent_key)
    return inner.filter("parent_side < 0").select(*NODE).unionByName(below.select(*NODE)).unionByName(shared.select(*NODE))
