"""Language identification by prediction by partial matching over bytes.

One byte context tree for each language, of orders 0 to 3, with frozen counts. The probability of a byte after a context is
count / (n + d); with d distinct followers the escape d / (n + d) goes to the shorter context, whose followers already seen are
excluded, down to a uniform distribution over all 256 bytes. A text's code length under a language is the exact sum over all
its bytes (A-Z count as a-z; three line feeds stand before the text); the shortest code wins, ties go to the first name.

Counts are learned from at most ``per_language`` labelled documents of each language, those with the smallest hash of the id,
and each language keeps its ``max_grams`` most frequent four-byte sequences: these two bounds are all that reaches the driver.
A text that is null or has no letter is ``und`` with score 0; so is every text if nothing was learned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, held, joined, text_bytes, text_chunks

ORDER = 3
_GAP = b"\n" * ORDER
_LETTER = regex.compile(r"\p{L}")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four-byte sequences and counts by language, for each chunk."""
    for batch in text_chunks(batches):
        langs, texts = np.array(batch["lang"].to_pylist(), dtype=object), text_bytes(batch["text"])
        for lang in sorted(set(langs)):
            buffer, _ = joined([_GAP + texts[k] for k in np.flatnonzero(langs == lang)], b"")
            if len(buffer) <= ORDER:
                continue
            b = LOWER[buffer].astype(np.uint32)
            gram, count = np.unique(b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(count.astype(np.int64))], names=["lang", "gram", "n"])


def learn(rows: DataFrame, per_language: int = 2000, max_grams: int = 200_000) -> dict[str, list[tuple[int, int]]]:
    """Counted sequences by language from labelled ``rows`` (doc_id, text, lang)."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("at", F.row_number().over(order)).filter(F.col("at") <= per_language)
    # At most ``per_language`` ids of each language.
    chosen = F.broadcast(chosen.select("doc_id", "lang").distinct())
    sample = rows.join(chosen, ["doc_id", "lang"], "left_semi").select("text", "lang")
    counts = sample.mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = counts.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= max_grams)
    model: dict[str, list[tuple[int, int]]] = {}
    for lang, gram, n in counts.select("lang", "gram", "n").collect():
        model.setdefault(lang, []).append((gram, n))
    return {lang: sorted(model[lang]) for lang in sorted(model)}


class Tree:
    """Code lengths of one language: a row of 256 for each context seen, found by its last three bytes."""

    def __init__(self, grams: list[tuple[int, int]]):
        codes = np.array([g for g, _ in grams], dtype=np.int64)
        counts = np.array([n for _, n in grams], dtype=np.float64)
        below = np.full((1, 256), 1 / 256)
        parent = np.zeros(0, dtype=np.int64)
        self.rows, contexts = [below], []
        for order in range(ORDER + 1):
            mask = (1 << 8 * order) - 1
            context = codes >> 8 & mask
            keys, row = np.unique(context, return_inverse=True)
            seen = np.bincount(row * 256 + (codes & 255), weights=counts, minlength=256 * len(keys)).reshape(-1, 256)
            parent = np.searchsorted(contexts[-1], keys & (mask >> 8)) if contexts else np.zeros(len(keys), dtype=np.int64)
            lower = below[parent]
            total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
            rest = np.where(seen > 0, 0, lower).sum(axis=1, keepdims=True)
            # With all bytes seen nothing can escape.
            escape = np.where(rest > 0, kinds / (total + kinds) / np.maximum(rest, 1e-300), 0)
            below = np.where(seen > 0, seen / np.where(rest > 0, total + kinds, total), escape * lower)
            contexts.append(keys)
            self.rows.append(below)
        self.table = -np.log2(np.concatenate(self.rows[1:])).astype(np.float32).ravel()
        base = np.cumsum([0, *(len(c) for c in contexts)])
        one = np.zeros(256, dtype=np.int32)
        one[contexts[1]] = base[1] + np.arange(len(contexts[1]))
        self.two = np.tile(one, 256)
        self.two[contexts[2]] = base[2] + np.arange(len(contexts[2]))
        # The row of a three-byte context: by the number of its first two bytes, 0 if these were never seen.
        firsts = np.unique(contexts[3] >> 8)
        self.first = np.zeros(1 << 16, dtype=np.int32)
        self.first[firsts] = 1 + np.arange(len(firsts))
        self.three = np.zeros((1 + len(firsts)) * 256, dtype=np.int32)
        self.three[self.first[contexts[3] >> 8] * 256 + (contexts[3] & 255)] = base[3] + np.arange(len(contexts[3]))

    def lengths(self, b: np.ndarray) -> np.ndarray:
        """Code length in bits of every byte from the fourth on."""
        pair = b[:-1].astype(np.int32) << 8 | b[1:]
        row = self.three[self.first[pair[:-2]] << 8 | b[2:-1]]
        row = np.where(row > 0, row, self.two[pair[1:-1]])
        return self.table[row << 8 | b[3:]]


def predict(trees: dict[str, Tree], texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability (of equally likely languages) of each text."""
    buffer, begins = joined([_GAP + x for x in texts], b"")
    names, bits = list(trees), np.zeros((len(trees), len(texts)))
    b = LOWER[buffer]
    sizes = np.diff(begins) - ORDER
    for k, tree in enumerate(trees.values()):
        sums = np.concatenate(([0.0], np.cumsum(tree.lengths(b), dtype=np.float64))) if len(b) > ORDER else np.zeros(1)
        bits[k] = sums[begins[:-1] + sizes] - sums[begins[:-1]]
    best = bits.argmin(axis=0) if names else np.zeros(len(texts), dtype=int)
    score = 1 / np.exp2(-np.minimum(bits - bits.min(axis=0), 1000)).sum(axis=0) if names else np.zeros(len(texts))
    known = np.array([bool(names) and bool(_LETTER.search(x.decode("utf-8", "replace"))) for x in texts], dtype=bool)
    return [names[i] if k else "und" for i, k in zip(best, known)], np.where(known, score, 0.0)


def languages(docs: DataFrame, model: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held(name, lambda: {lang: Tree(grams) for lang, grams in model.items()})
        for batch in text_chunks(batches):
            lang, score = predict(trees, text_bytes(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
