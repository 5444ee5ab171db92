"""Importance resampling against a plain version: features, weights, noise, ranks."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tidehouse.llm import resampling

ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, width):
    words = WORD.findall((text or "").encode().translate(ASCII))
    return [b" ".join(words[k : k + n]) for n in range(1, width + 1) for k in range(len(words) - n + 1)], len(words)


def plain_draw(docs, target, percent, least_words, width, buckets, seed=2024):
    """Rows (doc_id, n_words, n_features, weight, score, rank); equal rows stand for each other."""
    bucket = lambda feature: zlib.crc32(feature) % buckets
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in plain_features(text, width)[0]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in docs:
        found, n_words = plain_features(text, width)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = percent * len(order) // 100
    ranks = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(order)] + [(*r, None) for r in out if r[1] < least_words]
    return sorted(ranks, key=str)


def check_draw(spark, docs, target, shards=4, percent=10, least_words=20, width=1, buckets=10_000):
    rows = docs.select("doc_id", "text").collect()
    texts = [r.text for r in target.select("text").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = resampling.resample(docs, target, percent, least_words, width, buckets).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in found), key=str) == plain_draw([tuple(r) for r in rows], texts, percent, least_words, width, buckets)
    return found


def test_draw_of_odd_rows(spark, odd_docs):
    check_draw(spark, odd_docs, odd_docs, percent=60, least_words=1, buckets=50)


def test_runs_of_several_words(spark, odd_docs):
    check_draw(spark, odd_docs, odd_docs.limit(0), percent=100, least_words=1, width=3, buckets=97)


@pytest.mark.parametrize("percent", [0, 10, 35, 100])
def test_draw_of_documents(spark, docs, percent):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    check_draw(spark, docs.repartition(5), target, 7, percent)


def test_equal_rows_spread_over_segments(spark):
    """Two thirds of the rows are one row; each still has its own rank, and no segment holds them all."""
    rows = [(5 if k % 3 else k, "one two three " * 8) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = check_draw(spark, df, df, 8, 90)
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 2701))
    scored = resampling.weighted(df, np.zeros(10_000, dtype=np.int64)).withColumn("score", resampling.noise("doc_id", 1))
    sizes = {}
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        out = resampling.ranked(scored, 100, 1)
        sizes = {r[0]: r[1] for r in out.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) >= 8 and max(sizes.values()) < 1000


def test_drawn_documents_keep_their_columns(spark, docs):
    ranks = resampling.resample(docs, docs, percent=50)
    ids = {r.doc_id for r in ranks.filter("rank IS NOT NULL").collect()}
    drawn = resampling.drawn_documents(docs, ranks)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == ids


def test_draw_of_no_rows(spark, no_docs):
    assert resampling.resample(no_docs, no_docs).count() == 0


def test_the_crc_is_that_of_the_bytes():
    words = [b"a", b"", b"abc" * 40, "中文".encode(), b"x" * 70_000, b"z"]
    buffer = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    state = resampling._crc_after(np.full(len(words), 0xFFFFFFFF, dtype=np.uint32), buffer, starts, ends)
    assert [int(x) ^ 0xFFFFFFFF for x in state] == [zlib.crc32(w) for w in words]
