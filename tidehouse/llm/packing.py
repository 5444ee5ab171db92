"""Lexical retrieval packing: windows of a fixed number of ids, filled with the BM25 neighbours of a seed document.

Every document (null text: empty) becomes the tokenizer's ids and one end id. Whole windows of a long document are sequences of
their own; the rest of each document is an item. Items are sorted by a weighted min-hash of their ids, which puts alike documents
side by side, and dealt out by that order, so copies spread over as many partitions as they need. Each ``shard`` of at most
``shard_items`` successive items has an inverted index (id -> items, BM25 weights with document frequencies and the mean length of the
whole table). The next unused item is the seed: the index returns its neighbours by score, and unused ones fill the window. The last one is
cut to fit; its rest is the next seed. A window still open at the end of a shard goes on in the next one, and at the end of a
partition it is split into sequences whose lengths are powers of two, so there is no padding at all.

Only the table of document frequencies (one number for each id of the vocabulary) reaches the driver. Equal rows are packed
separately. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import held, partitions, text_chunks, written
from .token_ids import Encoder

_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _pieces_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _PIECES.split(", ")])


def tokenized(docs: DataFrame, path: str, end_id: int, kind: str, chunk_bytes: int = 1 << 22, remembered: int = 800_000) -> DataFrame:
    """(doc_id, ids) of every row: ids as little-endian numbers of the kind, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(f"tokenizer {path} {remembered}", lambda: Encoder(path, remembered))
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in text_chunks(batches, limit=chunk_bytes):
            texts = [t or "" for t in batch["text"].to_pylist()]
            ids = [x.astype(kind).tobytes() + end for x in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def _whole_windows(window: int, kind: str):
    """Pieces of the documents that fill whole windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Apart from the numbers of the packed sequences, which have the highest bits 0.
        number = (1 << 62) + (TaskContext.get().partitionId() << 40)
        for batch in text_chunks(batches, column="ids"):
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist()):
                every = np.frombuffer(ids, dtype=kind).astype("<u4")
                n = len(every)
                for start in range(0, n - window + 1, window):
                    rows.append((doc_id, start, window, n, number, 0, every[start : start + window].tobytes()))
                    number += 1
            yield _pieces_batch(rows)

    return run


def _frequencies(window: int, kind: str, vocabulary: int):
    """Items of a partition that hold each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in text_chunks(batches, column="ids"):
            rests = [np.frombuffer(x, dtype=kind) for x in batch["ids"].to_pylist()]
            rests = [x[len(x) // window * window :] for x in rests]
            for low in range(0, len(rests), 200):
                some = rests[low : low + 200]
                held = np.zeros((len(some), vocabulary), dtype=bool)
                held[np.repeat(np.arange(len(some)), [len(x) for x in some]), np.concatenate(some)] = True
                counts += np.count_nonzero(held, axis=0)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    return run


def _items(window: int, kind: str, idf: np.ndarray):
    """The rest of each document after its whole windows, and its place in the order of likeness."""
    # A fixed draw for each id, over its idf: documents that share rare ids have the same smallest ones.
    draw = -np.log(np.random.default_rng(7).random(len(idf))) / np.maximum(idf, 1e-6)
    by_rank = np.argsort(draw, kind="stable")
    rank = np.empty(len(by_rank) + 1, dtype=np.int64)
    rank[by_rank] = np.arange(len(by_rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, column="ids"):
            every = [np.frombuffer(x, dtype=kind) for x in batch["ids"].to_pylist()]
            n = np.array([len(x) for x in every], dtype=np.int64)
            start = n // window * window
            some = np.flatnonzero(start < n)
            rests = [every[k][start[k] :] for k in some]
            if not rests:
                continue
            ranks = rank[np.concatenate(rests)]
            size = (n - start)[some]
            first = np.cumsum(size) - size
            least = np.minimum.reduceat(ranks, first)
            ranks[ranks == np.repeat(least, size)] = len(by_rank)
            second = np.minimum.reduceat(ranks, first)
            second = np.where(second == len(by_rank), least, second)
            place = by_rank[least].astype(np.int64) << 32 | by_rank[second]
            rows = pa.array(some)
            columns = [batch["doc_id"].take(rows), pa.array(n[some]), pa.array(start[some]), pa.array(place), pa.array([x.tobytes() for x in rests], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "doc_tokens", "start", "place", "ids"])

    return run


class Shard:
    """Inverted index over items, with BM25 weights.

    The postings of an id that a sixteenth of the items hold are a row with a weight for each item; those of the others are lists.
    """

    def __init__(self, items: list[np.ndarray], idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75):
        self.size = len(items)
        sizes = np.array([len(ids) for ids in items], dtype=np.int64)
        owner = np.repeat(np.arange(self.size, dtype=np.int64), sizes)
        # One entry for each id of each item, by item and id.
        key, count = np.unique(owner * len(idf) + np.concatenate(items), return_counts=True)
        owner, term = key // len(idf), key % len(idf)
        length = k1 * (1 - b + b * sizes / mean)
        weight = idf[term] * count * (k1 + 1) / (count + length[owner])
        self.known, place = np.unique(term, return_inverse=True)
        self.terms = np.split(place, np.searchsorted(owner, np.arange(1, self.size)))
        number = np.bincount(place, minlength=len(self.known))
        wide = number * 16 >= self.size
        self.row = np.where(wide, np.cumsum(wide) - 1, -1)
        self.rows = np.zeros((int(wide.sum()), self.size), dtype=np.float32)
        self.rows[self.row[place[wide[place]]], owner[wide[place]]] = weight[wide[place]]
        narrow = np.flatnonzero(~wide[place])
        order = narrow[np.argsort(place[narrow], kind="stable")]
        self.owners, self.weights = owner[order], weight[order]
        self.count = np.where(wide, 0, number)
        self.first = np.cumsum(self.count) - self.count

    def scores(self, k: int) -> np.ndarray:
        """BM25 score of every item for the terms of item ``k``."""
        at = self.terms[k]
        row = self.row[at]
        out = self.rows[row[row >= 0]].sum(axis=0, dtype=np.float64)
        at = at[row < 0]
        first, count = self.first[at], self.count[at]
        total = np.cumsum(count)
        if len(at):
            postings = np.arange(total[-1]) + np.repeat(first - (total - count), count)
            out += np.bincount(self.owners[postings], weights=self.weights[postings], minlength=self.size)
        return out


class Packer:
    """Fills windows of one partition, shard by shard."""

    def __init__(self, window: int, idf: np.ndarray, mean: float, number: int):
        self.window, self.idf, self.mean, self.number = window, idf, mean, number
        self.open: list[tuple] = []
        self.room = window
        self.done: list[tuple] = []

    def _place(self, doc_id: int | None, tokens: int, start: int, ids: np.ndarray) -> None:
        self.open.append((doc_id, start, len(ids), tokens, self.number, self.window - self.room, ids.astype("<u4").tobytes()))
        self.room -= len(ids)
        if not self.room:
            self.done += self.open
            self.open, self.room = [], self.window
            self.number += 1

    def add(self, items: list[tuple]) -> None:
        """Packs a shard of (doc_id, tokens, start, ids)."""
        index = Shard([x[3] for x in items], self.idf, self.mean)
        used = np.zeros(len(items), dtype=bool)
        seed, at, first = None, 0, 0  # of the seed, ``at`` ids are placed already
        while True:
            if seed is None:
                while first < len(items) and used[first]:
                    first += 1
                if first == len(items):
                    return
                seed, at = first, 0
            scores = index.scores(seed)
            scores[seed] = np.inf
            ranked = np.argsort(-scores, kind="stable")
            number, seed = self.number, None
            for k in ranked[~used[ranked]].tolist():
                doc_id, tokens, start, ids = items[k]
                part = ids[at : at + self.room]
                self._place(doc_id, tokens, start + at, part)
                if at + len(part) < len(ids):
                    seed, at = k, at + len(part)
                else:
                    used[k], at = True, 0
                if self.number != number:
                    break

    def close(self) -> None:
        """Splits the open window into sequences of powers of two."""
        rest, self.open = self.open, []
        left = self.window - self.room
        while left:
            size = 1 << (left.bit_length() - 1)
            filled = 0
            while filled < size:
                doc_id, start, length, tokens, _, _, ids = rest.pop(0)
                take = min(length, size - filled)
                self.done.append((doc_id, start, take, tokens, self.number, filled, ids[: 4 * take]))
                if take < length:
                    rest.insert(0, (doc_id, start + take, length - take, tokens, 0, 0, ids[4 * take :]))
                filled += take
            self.number += 1
            left -= size
        self.room = self.window


def _pack(window: int, kind: str, idf: np.ndarray, mean: float, shard_items: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, idf, mean, TaskContext.get().partitionId() << 40)
        held: list[tuple] = []
        for batch in text_chunks(batches, column="ids"):
            columns = (batch[c].to_pylist() for c in ("doc_id", "doc_tokens", "start", "ids"))
            for doc_id, tokens, start, ids in zip(*columns):
                held.append((doc_id, tokens, start, np.frombuffer(ids, dtype=kind)))
                if len(held) == shard_items:
                    packer.add(held)
                    yield _pieces_batch(packer.done)
                    held, packer.done = [], []
        if held:
            packer.add(held)
        packer.close()
        yield _pieces_batch(packer.done)

    return run


def pack(
    docs: DataFrame, window: int = 2048, shard_items: int = 512, end_id: int = 1, tokenizer: str | None = None,
    chunk_bytes: int = 1 << 22, remembered: int = 800_000,
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) that hold every id of ``docs`` (doc_id, text) once.

    A worker tokenizes ``chunk_bytes`` of text at once and keeps ``remembered`` tokenized words: memory against time, not results.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    # Ids take two bytes between the stages if the vocabulary allows it.
    largest = max(*Tokenizer.from_file(path).get_vocab().values(), end_id)
    kind = "<u2" if largest < 1 << 16 else "<u4"
    tokens = written(tokenized(docs, path, end_id, kind, chunk_bytes, remembered), "tokens")
    counts = tokens.mapInArrow(_frequencies(window, kind, largest + 1), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    rest = F.expr(f"length(ids) div {kind[2]} % {window}")
    size, total = tokens.agg(F.count_if(rest > 0), F.sum(rest)).first()
    ids, n = counts["id"].to_numpy(), counts["n"].to_numpy()
    idf = np.zeros(int(ids.max()) + 1 if len(ids) else 1)
    idf[ids] = np.log1p((size - n + 0.5) / (n + 0.5))
    mean = (total or 0) / max(size, 1)

    items = tokens.mapInArrow(_items(window, kind, idf), "doc_id long, doc_tokens long, start long, place long, ids binary")
    order = ["place", "doc_id", "doc_tokens", F.crc32("ids")]
    items = items.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    packed = items.mapInArrow(_pack(window, kind, idf, mean, shard_items), _PIECES)
    return tokens.mapInArrow(_whole_windows(window, kind), _PIECES).unionByName(packed)
