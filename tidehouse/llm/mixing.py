"""Mixing to target weights with soft membership.

A classifier learned from a labelled table (doc_id, domain) gives each document posteriors p over the domains: multinomial logistic
regression on the square roots of hashed byte-pair shares, fitted on at most ``max_rows`` labelled documents (smallest hash of
the id). With n words, a document's rate r brings r * n * p[k] expected words of domain k. Nonnegative rates, starting at 1, are
fitted to the targets by projected gradient least squares: r <- max(0, r - p . d). The gradient's K sums are added up over all
documents in each round; d is the gradient scaled by the inverse of the K x K second moments (computed once, over all documents)
and halved until the squared error falls. Since a rate follows from p and the list of steps, the rounds keep no table.

Without a given total, the targets are the largest totals that need no domain's words more than once, so documents of a scarce
domain stay whole. Domains without labelled rows have posterior 0 and stay short of their target; without labelled rows every
rate is 1. Null and empty texts have 0 words and the posterior of no evidence. Repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, joined, text_bytes, text_chunks, word_spans, written

BINS = 512


def _evidence(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of each text."""
    b, begins = joined(texts)
    starts, _ = word_spans(b, SPACE)
    n = len(texts)
    n_words = np.bincount(np.searchsorted(begins, starts, side="right") - 1, minlength=n)
    b = LOWER[b].astype(np.int32)
    pair = ((b[:-1] << 8 | b[1:]) * 40503 >> 7) & (BINS - 1)
    doc = np.repeat(np.arange(n, dtype=np.int64) * BINS, np.diff(begins))[:-1]
    counts = np.bincount(doc + pair, minlength=n * BINS)[: n * BINS].reshape(n, BINS)
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.hstack([np.sqrt(shares), np.ones((n, 1))]), n_words


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], max_rows: int = 5000, rounds: int = 400) -> np.ndarray | None:
    """Weights (features x domains) from ``labelled`` (doc_id, domain); None without labelled documents."""
    labels = labelled.filter(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    # The fit needs only documents that are there; they are counted off by hash.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = labels.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_rows).select("doc_id", "domain")
    sample = rows.join(F.broadcast(chosen), "doc_id").select("text", "domain")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            x, _ = _evidence(text_bytes(batch["text"]))
            yield pa.RecordBatch.from_arrays([pa.array(list(x.astype(np.float32))), batch["domain"]], names=["x", "domain"])

    made = sample.mapInArrow(run, "x array<float>, domain string").orderBy("domain", "x").limit(2 * max_rows).toArrow()
    if not made.num_rows:
        return None
    x = np.array(made["x"].to_pylist(), dtype=np.float64)
    y = np.array([domains.index(d) for d in made["domain"].to_pylist()])
    target = np.eye(len(domains))[y]
    absent = target.sum(axis=0) == 0
    weights = np.zeros((x.shape[1], len(domains)))
    momentum = np.zeros_like(weights)
    lip = 0.5 * np.linalg.norm(x, 2) ** 2 / len(x)
    for k in range(rounds):
        ahead = weights + k / (k + 3) * momentum
        z = x @ ahead
        z[:, absent] = -1e9
        gradient = x.T @ (_softmax(z) - target) / len(x) + 1e-5 * ahead
        new = ahead - gradient / lip
        momentum, weights = new - weights, new
    weights[:, absent] = 0
    weights[-1, absent] = -1e9
    return weights


def posteriors(docs: DataFrame, weights: np.ndarray, domains: list[str]) -> DataFrame:
    """(doc_id, tie, n_words, p) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            x, n = _evidence(text_bytes(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tie"], pa.array(n.astype(np.int64)), pa.array(list(_softmax(x @ weights)))], names=["doc_id", "tie", "n_words", "p"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, tie long, n_words long, p array<double>")


def rate_of(steps: list[np.ndarray], size: int) -> Column:
    """The rate after the steps: r <- max(0, r - p . d), from 1."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    moves = F.array(*(F.array(*(F.lit(float(v)) for v in d)) for d in steps))

    def move(r: Column, d: Column) -> Column:
        return F.greatest(F.lit(0.0), r - sum((F.col("p")[k] * d[k] for k in range(size)), F.lit(0.0)))

    return F.aggregate(moves, rate, move)


def fit(rows: DataFrame, targets: dict[str, float], total: float | None = None, rounds: int = 25, tolerance: float = 1e-6) -> list[np.ndarray]:
    """Steps of the projected gradient for ``rows`` (n_words, p)."""
    size = len(targets)
    weights = np.array(list(targets.values()), dtype=np.float64)
    weights = weights / weights.sum()

    def sums(steps: list[np.ndarray]) -> np.ndarray:
        at = rows.withColumn("rate", rate_of(steps, size))
        got = at.agg(*(F.sum(F.col("n_words") * F.col("rate") * F.col("p")[k]) for k in range(size))).first()
        return np.array([v or 0.0 for v in got])

    moments = rows.agg(*(F.sum(F.col("n_words") * F.col("p")[i] * F.col("p")[j]) for i in range(size) for j in range(size))).first()
    moments = np.array([v or 0.0 for v in moments]).reshape(size, size)
    now = sums([])
    words = now.sum()
    if not words:
        return []
    if total is None:
        usable = (weights > 0) & (now > 1e-6 * words)
        total = float(np.min(now[usable] / weights[usable])) if usable.any() else 0.0
    goal = weights * total
    inverse = np.linalg.inv(moments + 1e-6 * words * np.eye(size))
    steps: list[np.ndarray] = []
    error = np.square((now - goal) / words).sum()
    for _ in range(rounds):
        if error < tolerance**2:
            break
        step = inverse @ (now - goal)
        for _ in range(8):
            after = sums([*steps, step])
            new = np.square((after - goal) / words).sum()
            if new < error:
                break
            step = step / 2
        else:
            break
        gain = 1 - new / error
        steps, now, error = [*steps, step], after, new
        if gain < 1e-4:
            break
    return steps


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> DataFrame:
    """(doc_id, tie, n_words, p, rate) of every row; ``tie`` is the hash of the text, ``p`` follows the order of ``targets``."""
    domains = list(targets)
    weights = classifier(docs, labelled, domains)
    if weights is None:
        none = F.array(*(F.lit(0.0) for _ in domains))
        words = F.size(F.array_remove(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), ""))
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), words.cast("long").alias("n_words"), none.alias("p"), F.lit(1.0).alias("rate"))
    rows = written(posteriors(docs, weights, domains), "posteriors")
    return rows.withColumn("rate", rate_of(fit(rows, targets, total), len(domains)))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> DataFrame:
    """Rows of ``docs`` as often as their rate says: its whole part, and once more if a hash of the row is below the rest.

    The hash depends on id and text, so a repeated run or a recomputed task decides alike. Columns are those of ``docs``.
    """
    chance = F.abs(F.xxhash64("doc_id", "tie", F.lit(7)) % (1 << 40)) / float(1 << 40)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    made = rates(docs, labelled, targets, total).withColumn("copies", copies)
    # Rows of one id and text have one rate.
    chosen = made.groupBy("doc_id", "tie").agg(F.max("copies").alias("copies")).toDF("_mix_id", "_mix_tie", "_mix_copies")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_mix_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_mix_tie"))
    out = docs.join(chosen.filter("_mix_copies > 0"), same)
    copy = F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))).alias("_mix_copy")
    return out.select(*(docs[c] for c in docs.columns), copy).drop("_mix_copy")
