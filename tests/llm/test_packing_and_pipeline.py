"""Tokenizer ids, packing and the whole pipeline."""

from __future__ import annotations

import public_tokenizers
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tidehouse.llm import packing
from tidehouse.llm.token_ids import Encoder

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, remembered=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'stvelrmd  \n\t\r.,!12éß½ 中\u0085\x1c")), max_size=40), max_size=6))
def test_ids_are_the_tokenizers(encoder, texts):
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def check_packing(docs, window):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    wanted = sorted(((i is None, i or 0), [*tokenizer.encode(t, add_special_tokens=False).ids, 1]) for i, t in texts)
    rows = packing.pack(docs, window=window, shard_items=16).collect()
    sequences, pieces = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id is None, r.doc_id or 0), []).append((r.start, r.doc_tokens, ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)
    assert len(sequences) <= sum(len(x) for _, x in wanted) / window + 4 * 12
    # Documents of one id are told apart by their length where it differs.
    for key in {k for k, _ in wanted}:
        own = sorted(x for k, x in wanted if k == key)
        assert sorted(len(x) for x in own for _ in range(1)) == sorted(
            n for n in {p[1] for p in pieces[key]} for _ in range(sum(len(p[2]) for p in pieces[key] if p[1] == n) // n))
        if len(own) == 1:
            assert [i for *_, ids in sorted(pieces[key]) for i in ids] == own[0]


def test_packing_holds_each_id_once(docs):
    check_packing(docs, 2048)


def test_packing_of_odd_rows(odd_docs, no_docs):
    check_packing(odd_docs, 64)
    assert packing.pack(no_docs).count() == 0


def test_neighbours_share_a_window(spark):
    """Documents of the same words are packed together."""
    rng = np.random.default_rng(1)
    known = sorted(t[1:] for t in Tokenizer.from_file(PATH).get_vocab() if t[0] == "Ġ" and t[1:].isalpha() and len(t) == 7)
    rows = [(k, " ".join(known[k % 8 * 100 + x] for x in rng.integers(0, 100, 40))) for k in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack(df, window=160).collect()
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append(r.doc_id % 8)
    share = [max(v.count(x) for x in v) / len(v) for v in by.values() if len(v) > 2]
    assert np.mean(share) > 0.6


def test_scores_are_bm25():
    items = [np.array(x) for x in ([1, 2, 2, 3], [2, 4], [5, 6, 1], [7])]
    idf = np.arange(8) / 10 + 0.1
    index = packing.Shard(items, idf, mean=2.5)
    for k, query in enumerate(items):
        expected = []
        for item in items:
            score = 0.0
            for term in set(query.tolist()) & set(item.tolist()):
                tf = item.tolist().count(term)
                score += idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(item) / 2.5))
            expected.append(score)
        assert np.allclose(index.scores(k), expected)


def test_stages_keep_the_columns_of_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, SF)
        assert out.columns == odd_docs.columns, name
        assert {str(r) for r in out.select("doc_id", "lang").collect()} <= {str(r) for r in odd_docs.select("doc_id", "lang").collect()}
        assert stage(spark, no_docs, SF).count() == 0, name


def test_pipeline(spark, docs):
    """Everything comes through in order, and the pieces hold what the last stage was given."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "packing"]
    kept = docs
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SF).toArrow())
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * docs.count()
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in kept.collect()}
