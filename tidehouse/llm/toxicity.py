"""Toxicity from a learned lexicon, matched through Levenshtein automata, weighed by context windows.

Lexicon: words (ASCII lower case; letters, digits and characters beyond ASCII) of labelled documents whose share of toxic
documents is at least ``e ** least_odds`` times that of clean ones, in ``least_docs`` toxic documents or more, and in as many
different contexts (the words before and after), so that copies of one toxic text teach nothing; the ``max_terms``
words with the strongest evidence, as a trie. A word within one edit of a term of five letters or more is a hit: the word's
Levenshtein automaton (its states are rows of the edit table) walks the trie and leaves branches on which no state is alive.

Context: a hit between quotation marks, both within ``window`` bytes of it, counts as quoted, otherwise as abuse. A document's
features are the summed and largest weights of exact and misspelled hits outside quotations, the summed weight inside, hits per
word and its length. A logistic regression over them gives the score, so how much a quotation counts is learned too.

Learning uses at most ``max_rows`` different labelled texts, those with the smallest hash; lexicon and weights are all that
reaches the driver besides their features. Without labelled rows, or of one class only, every score is the class's share or 0.
Null and empty texts get the score of a text without hits. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, NOT_ALNUM, distinct_spans, held, joined, span_hashes, text_bytes, text_chunks, word_spans, written

#: Quotation marks (fixed values).
QUOTES = tuple(q.encode() for q in '"“”«»„')
N_FEATURES = 8


class Lexicon:
    """Trie of weighted terms, and the words already looked up."""

    def __init__(self, terms: list[tuple[str, float]], least_letters: int = 5):
        self.weights = dict(terms)
        self.least_letters = least_letters
        self.root: dict = {}
        self.known: dict[bytes, tuple[float, int] | None] = {}
        for term in self.weights:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
        # One edit leaves the first or the second half of a term as it is; of a half at most eight bytes are compared.
        self.heads: dict[int, np.ndarray] = {}
        self.tails: dict[int, np.ndarray] = {}
        for kept, cut in ((self.heads, lambda t: t[: len(t) // 2].encode()[:8]), (self.tails, lambda t: t[len(t) // 2 :].encode()[-8:])):
            halves = {cut(term) for term in self.weights}
            for size in {len(h) for h in halves}:
                kept[size] = np.array(sorted(int.from_bytes(h, "big") for h in halves if len(h) == size), dtype=np.uint64)

    def candidates(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words that begin or end with half of a term: a superset of the hits."""
        size = ends - starts
        found = np.zeros(len(starts), dtype=bool)
        head, tail = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(starts), dtype=np.uint64)
        for k in range(1, 9):
            head = head << np.uint64(8) | b[np.minimum(starts + (k - 1), len(b) - 1)]
            tail |= b[np.maximum(ends - k, 0)].astype(np.uint64) << np.uint64(8 * (k - 1))
            for code, known in ((head, self.heads.get(k)), (tail, self.tails.get(k))):
                if known is not None:
                    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
                    found |= (known[at] == code) & (size >= k)
        return np.flatnonzero(found)

    def match(self, word: bytes) -> tuple[float, int] | None:
        """(weight, edits) of the nearest term, of equally near ones the heaviest."""
        if word not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[word] = self._walk(word.decode("utf-8", "replace"))
        return self.known[word]

    def _walk(self, word: str) -> tuple[float, int] | None:
        if word in self.weights:
            return self.weights[word], 0
        if len(word) < self.least_letters - 1:
            return None
        best = None
        size = len(word)
        stack = [(self.root, (0, 1), 0, 0)]
        # A state holds the edits of the columns from ``low`` on that are still at most one; the others are dead.
        while stack:
            node, row, low, depth = stack.pop()
            if "" in node and low + len(row) > size and row[size - low] <= 1 and depth >= self.least_letters:
                weight = self.weights[node[""]]
                best = max(best or 0.0, weight)
            for letter, child in node.items():
                if not letter:
                    continue
                new, start = [], max(0, low)
                for column in range(start, min(size, low + len(row)) + 1):
                    up = row[column - low] + 1 if column - low < len(row) else 2
                    across = row[column - 1 - low] + (word[column - 1] != letter) if column > low else 2
                    left = new[-1] + 1 if new else 2
                    new.append(min(2, up, across, left))
                while new and new[0] > 1:
                    new.pop(0)
                    start += 1
                while new and new[-1] > 1:
                    new.pop()
                if new:
                    stack.append((child, tuple(new), start, depth + 1))
        return None if best is None else (best, 1)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents of a chunk each word occurs."""
    for batch in text_chunks(batches):
        b, begins = joined(text_bytes(batch["text"]))
        b = LOWER[b]
        starts, ends = word_spans(b, NOT_ALNUM)
        if not len(starts):
            continue
        first, word = distinct_spans(b, starts, ends)
        doc = np.searchsorted(begins, starts, side="right") - 1
        in_doc = np.unique(word.astype(np.int64) * batch.num_rows + doc)
        toxic = np.array(batch["toxic"].to_pylist())[in_doc % batch.num_rows]
        n_toxic = np.bincount(in_doc // batch.num_rows, weights=toxic, minlength=len(first))
        n = np.bincount(in_doc // batch.num_rows, minlength=len(first))
        raw = b.tobytes()
        words = [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[first].tolist(), ends[first].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n_toxic.astype(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n_toxic", "n"])


def _contexts(words: list[str]):
    """Different contexts of some words in toxic and clean texts, as hashes."""
    known = np.array(sorted(_span_hash(w) for w in words), dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            b, begins = joined(text_bytes(batch["text"]))
            b = LOWER[b]
            starts, ends = word_spans(b, NOT_ALNUM)
            if not len(starts) or not len(known):
                continue
            h = span_hashes(b, starts, ends)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h)
            context = np.roll(h, 1)[at] * np.uint64(3) + np.roll(h, -1)[at]
            doc = np.searchsorted(begins, starts[at], side="right") - 1
            toxic = np.array(batch["toxic"].to_pylist(), dtype=np.int32)[doc]
            raw = b.tobytes()
            names = [raw[starts[k] : ends[k]].decode("utf-8", "replace") for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(context.view(np.int64)), pa.array(toxic)], names=["word", "context", "toxic"])

    return run


def _span_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(b, np.zeros(1, dtype=np.int64), np.array([len(b)]))[0])


def _features(lexicon: Lexicon, texts: list[bytes], window: int) -> np.ndarray:
    b, begins = joined(texts, b"\n\n")
    raw = b.tobytes()
    b = LOWER[b]
    low = b.tobytes()
    starts, ends = word_spans(b, NOT_ALNUM)
    n = len(texts)
    doc = np.searchsorted(begins, starts, side="right") - 1
    hits = []
    for k in lexicon.candidates(b, starts, ends).tolist() if lexicon.weights else ():
        found = lexicon.match(low[starts[k] : ends[k]])
        if found:
            hits.append((k, *found))
    out = np.zeros((n, N_FEATURES))
    out[:, 0] = 1
    n_words = np.bincount(doc, minlength=n)
    out[:, 1] = np.log1p(n_words) / 10
    for k, weight, edits in hits:
        row = out[doc[k]]
        left, right = int(begins[doc[k]]), int(begins[doc[k] + 1])
        before = raw[max(left, int(starts[k]) - window) : starts[k]]
        after = raw[ends[k] : min(right, int(ends[k]) + window)]
        row[7] += 1
        if any(q in before for q in QUOTES) and any(q in after for q in QUOTES):
            row[6] += weight
        else:
            row[2 + edits] += weight
            row[4 + edits] = max(row[4 + edits], weight)
    out[:, [2, 3, 6]] = np.log1p(out[:, [2, 3, 6]])
    out[:, 7] = np.log1p(100 * out[:, 7] / np.maximum(n_words, 1))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Newton's method on at most ``max_rows`` rows."""
    weights = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


class Model:
    def __init__(self, terms: list[tuple[str, float]], weights: list[float], window: int):
        self.terms, self.weights, self.window = terms, weights, window

    def scores(self, lexicon: Lexicon, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(lexicon, texts, self.window) @ np.array(self.weights), -30, 30)))


def learn(
    docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, max_terms: int = 2000, least_docs: int = 4, least_odds: float = 3.0,
    window: int = 120,
) -> Model:
    """Model from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); rows without a label are left out."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    # Ids and hashes meet the labels; of the texts only the sample's, whose ids are few enough to broadcast, are moved.
    hashed = rows.select("doc_id", F.xxhash64("text").alias("h")).join(known, "doc_id")
    bound = hashed.groupBy("h").agg(F.min(F.struct("doc_id", "toxic")).alias("one")).orderBy("h").limit(max_rows)
    bound = bound.select("one.doc_id", "one.toxic").distinct()
    chosen = written(rows.join(F.broadcast(bound), "doc_id").select("text", "toxic"), "toxicity-sample")
    n = {t: c for t, c in chosen.groupBy("toxic").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model([], [30.0 if toxic else -30.0] + [0.0] * (N_FEATURES - 1), window)
    counts = chosen.mapInArrow(_word_counts, "word string, n_toxic long, n long").groupBy("word").agg(F.sum("n_toxic").alias("a"), F.sum("n").alias("n"))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("a") + 0.5) / (clean + 1))
    best = counts.filter((F.col("a") >= least_docs) & (F.length("word") > 3)).withColumn("odds", odds).filter(F.col("odds") >= least_odds)
    found = {r.word: r.odds for r in best.orderBy(F.desc(F.col("odds") * F.col("a")), "word").limit(4 * max_terms).collect()}
    contexts = chosen.mapInArrow(_contexts(list(found)), "word string, context long, toxic int").distinct()
    seen = contexts.groupBy("word").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).collect()
    share = {r.word: (r.a + 0.5) / (r.n - r.a + 0.5) * (clean + 1) / (toxic + 1) for r in seen if r.a >= least_docs}
    terms = [(w, odds) for w, odds in found.items() if math.log(share.get(w, 1e-9)) >= least_odds][:max_terms]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in text_chunks(batches):
            x = _features(lexicon, text_bytes(batch["text"]), window)
            yield pa.RecordBatch.from_arrays([pa.array(list(x)), batch["toxic"]], names=["x", "toxic"])

    made = chosen.mapInArrow(run, "x array<double>, toxic int").collect()
    weights = _logistic(np.array([r.x for r in made]), np.array([float(r.toxic) for r in made]))
    return Model(terms, weights.tolist(), window)


def scored(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` (with ``text``) and the score, 0 to 1, in ``column``; a column of that name is replaced."""
    docs = docs.drop(column)
    names, token = docs.columns, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Once for each Python worker, with the words it has looked up.
        lexicon = held(token, lambda: Lexicon(model.terms))
        for batch in text_chunks(batches):
            scores = model.scores(lexicon, text_bytes(batch["text"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(column, T.DoubleType())]))
