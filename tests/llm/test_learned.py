"""Learned operators: held-out accuracy, exact sums, gradients, and odd rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidehouse.llm import attention_lm, language_id, mixing, toxicity
from tidehouse.llm.common import id_bucket
from tidehouse.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    out = QUERIES["op10_ppm_language"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = out.join(docs, "doc_id").select("doc_id", "held_out", "lang_pred", "lang", "score").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.99


def test_language_of_odd_rows(odd_docs, no_docs, docs):
    model = language_id.learn(docs, per_language=50)
    rows = language_id.languages(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert language_id.languages(no_docs, model).count() == 0
    assert language_id.learn(no_docs) == {}
    assert {r.lang_pred for r in language_id.languages(docs, {}).collect()} == {"und"}


def test_code_lengths_are_exact():
    """Probabilities of a context add up to one, and escapes follow the definition step by step."""
    text = b"\n\n\nabracadabra abracadabra banana"
    grams = {}
    for i in range(len(text) - 3):
        key = int.from_bytes(text[i : i + 4], "big")
        grams[key] = grams.get(key, 0) + 1
    tree = language_id.Tree(sorted(grams.items()))
    assert np.allclose(np.exp2(-tree.table.reshape(-1, 256).astype(float)).sum(axis=1), 1, atol=1e-4)

    def probability(context, byte):
        order = len(context)
        counts = {}
        for gram, n in grams.items():
            raw = gram.to_bytes(4, "big")
            if raw[3 - order : 3] == context:
                counts[raw[3]] = counts.get(raw[3], 0) + n
        shorter = (lambda b: probability(context[1:], b)) if order else (lambda b: 1 / 256)
        if not counts:
            return shorter(byte)
        n, d = sum(counts.values()), len(counts)
        if byte in counts:
            return counts[byte] / (n + d)
        return d / (n + d) * shorter(byte) / (1 - sum(shorter(b) for b in counts))

    new = b"\n\n\nabrabanxa"
    got = tree.lengths(np.frombuffer(new, dtype=np.uint8))
    expected = [-math.log2(probability(new[i : i + 3], new[i + 3])) for i in range(len(new) - 3)]
    assert np.allclose(got, expected, atol=1e-4)


def test_toxicity_of_held_out_documents(spark):
    path = "/root/testdata/sf0.1"
    rows = QUERIES["op4_toxic_lexicon"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in held)
    assert hit / max(1, sum(r.predicted for r in held)) > 0.9
    assert hit / max(1, sum(r.toxic for r in held)) > 0.6


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automata_find_what_the_edit_table_finds():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcé"), int(rng.integers(3, 9)))) for _ in range(500)]
    terms = sorted(set(words[:60]))
    lexicon = toxicity.Lexicon([(t, float(k)) for k, t in enumerate(terms)])
    for word in words:
        near = [(edits(word, t), -k) for k, t in enumerate(terms) if edits(word, t) <= (len(t) >= 5)]
        got = lexicon.match(word.encode())
        assert got == ((float(-min(near)[1]), min(near)[0]) if near else None), word


def test_quotations_count_apart():
    lexicon = toxicity.Lexicon([("terrible", 2.0)])
    x = toxicity._features(lexicon, [b'you terible thing', b'he said "terrible" once', b"", b"TERRIBLE"], 120)
    assert x[0, 3] > 0 == x[0, 2] and x[1, 6] > 0 == x[1, 2] and x[2, 2:].sum() == 0 and x[3, 2] > 0


def test_toxicity_of_odd_rows(odd_docs, no_docs, docs, labels):
    model = toxicity.learn(docs, labels)
    out = toxicity.scored(odd_docs, model)
    assert out.columns == [*odd_docs.columns, "toxicity"]
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.scored(no_docs, model).count() == 0
    nothing = toxicity.learn(no_docs, labels)
    assert {round(r.toxicity, 6) for r in toxicity.scored(odd_docs, nothing).collect()} == {0.0}


def test_rates_meet_the_targets(spark, docs, labels):
    domain = F.when(F.col("quality") == 1, "high").otherwise("low")
    rows = mixing.rates(docs, labels.select("doc_id", domain.alias("domain")), {"high": 0.7, "low": 0.3}).collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 for r in rows)
    got = [sum(r.rate * r.n_words * r.p[k] for r in rows) for k in (0, 1)]
    assert got[0] / sum(got) == pytest.approx(0.7, abs=0.01)
    assert all(r.n_words == len((d.text or "").encode().split()) for r, d in zip(sorted(rows, key=lambda r: r.doc_id), docs.orderBy("doc_id").collect()))


def test_least_squares_against_a_dense_solution(spark):
    rng = np.random.default_rng(8)
    p = rng.dirichlet([0.5, 0.5, 0.5], 200)
    n = rng.integers(1, 500, 200)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_words long, p array<double>")
    total = float(n.sum())
    steps = mixing.fit(df, {"a": 0.6, "b": 0.3, "c": 0.1}, total)
    rate = [r[0] for r in df.select(mixing.rate_of(steps, 3)).collect()]
    assert np.allclose((np.array(rate) * n) @ p, np.array([0.6, 0.3, 0.1]) * total, rtol=0.01)


def test_mixing_of_odd_rows(odd_docs, no_docs, labels):
    named = labels.select("doc_id", F.when(F.col("quality") == 1, "high").otherwise("low").alias("domain"))
    targets = {"high": 0.9, "low": 0.1}
    out = mixing.mixed(odd_docs, named, targets)
    assert out.columns == odd_docs.columns and out.count() <= odd_docs.count()
    assert mixing.mixed(no_docs, named, targets).count() == 0
    assert mixing.mixed(odd_docs, named.limit(0), targets).count() == odd_docs.count()
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mixed(odd_docs, named, targets).collect()))


def plain_base(rows):
    """Base scores from (doc_id, text, train) rows."""
    counts = {}
    tokens = {k: [*(t or "").encode().lower().split(), None] for k, (_, t, _) in enumerate(rows)}
    for k, (_, _, train) in enumerate(rows):
        for w in tokens[k] if train else ():
            counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for k, (i, _, train) in enumerate(rows):
        c = [counts.get(w, 0) for w in tokens[k]]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (kinds + 1))) for x in c)
        out.append((i, train, len(c), sum(x > 0 for x in c), total, round(base, 6)))
    return sorted(map(str, out))


def check_base(df, **options):
    rows = [tuple(r) for r in df.select("doc_id", "text", "t").collect()]
    got = attention_lm.scored(df, "t", **options).collect()
    shown = [(r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(map(str, shown)) == plain_base(rows)
    assert all(r.score < 0 for r in got)
    return got


def test_lm_beats_the_base_on_held_out_documents(spark):
    rows = QUERIES["op3_attention_lm"](spark, SMALL).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_base_is_exact(docs):
    check_base(docs.withColumn("t", id_bucket("doc_id", 10) != 0), steps=20)


def test_lm_of_odd_rows(odd_docs, no_docs):
    check_base(odd_docs.withColumn("t", F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))), steps=5)
    check_base(odd_docs.withColumn("t", F.lit(False)), steps=5)
    assert attention_lm.scored(no_docs.withColumn("t", F.lit(True)), "t").count() == 0


def small_model():
    rng = np.random.default_rng(0)
    counts = np.append(rng.integers(0, 50, 400), 30).astype(float)
    model = attention_lm.Attention(counts)
    texts = [np.append(rng.integers(0, 400, int(n)), 400) for n in (0, 1, 35, 36, 37, 120)]
    model.group(texts)
    return model, texts


def test_lm_scores_are_log_probabilities():
    """The ids' probabilities add up to one, and a plain loop over positions gives the same score."""
    model, texts = small_model()
    got = model.scores(texts, model.prepared())
    p = model.p

    def log_softmax(z):
        return z - z.max() - np.log(np.exp(z - z.max()).sum())

    def distribution(h):
        """Log probability of every id."""
        of_class = log_softmax(h @ p["u"] + p["b"])
        out = of_class[model.classes] + model.share
        for k in range(len(model.first) - 1):
            members = np.flatnonzero(model.classes == k)
            own = log_softmax(h @ p["w"][:, model.first[k] : model.first[k + 1]] + p["c"][model.first[k] : model.first[k + 1]])
            out[members] += own[model.member[members] - model.first[k]]
        return out

    for text, score in zip(texts, got):
        inputs = np.concatenate(([model.end], text))
        total = 0.0
        step = attention_lm.WINDOW - attention_lm.OVERLAP
        for t in range(len(text)):
            begin = max(0, t // step * step - attention_lm.OVERLAP)
            x = p["e"][model.row[inputs[begin : t + 1]]]
            s = (x[-1] @ p["q"]) @ (x @ p["k"]).T * attention_lm.WIDTH**-0.5 + p["r"][np.arange(len(x))[::-1]]
            a = np.exp(s - s.max())
            every = distribution(x[-1] + (a / a.sum()) @ (x @ p["v"]) @ p["o"])
            total += every[text[t]]
            if t < 3:
                assert np.exp(every.astype(float)).sum() == pytest.approx(1, abs=1e-3)
        assert score == pytest.approx(total, rel=1e-3)


def test_lm_gradient():
    model, texts = small_model()
    inputs, hidden, wanted, valid, _ = model.windows(texts)
    args = model.row[inputs], hidden, model.classes[wanted], valid
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, g = model.gradient(*args)
    rng = np.random.default_rng(1)
    for name, value in model.p.items():
        at = tuple(int(rng.integers(0, n)) for n in value.shape)
        if name == "e":
            at = (int(args[0][0, -1]), at[1])
        keep = value[at]
        value[at] = keep + 1e-4
        up, _ = model.gradient(*args)
        value[at] = keep - 1e-4
        down, _ = model.gradient(*args)
        value[at] = keep
        assert g[name][at] == pytest.approx((up - down) / 2e-4, abs=2e-5), name


def test_subwords_of_grouped_words_are_the_tokenizers():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = "it's don't x y   ½ 中文 a.b, --- 'll é 12ab <|endoftext|>".split(" ")
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words]), pa.array([1] * len(words))], names=["word", "c"])
    out = next(attention_lm._encode(public_tokenizers.path("byte_bpe_50k.json"))([batch]))
    tokenizer.encode_special_tokens = True
    expected = [tokenizer.encode(" " + w, add_special_tokens=False).ids for w in words]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in out["ids"].to_pylist()] == expected


def test_lm_learns_from_every_training_document(spark):
    """A pair of words that only training documents outside the 1500 of smallest id hash hold is learned all the same."""
    ids = spark.range(3000).select(F.col("id").alias("doc_id"))
    first = ids.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(1500).select("doc_id", F.lit(True).alias("early"))
    train = ids.join(first, "doc_id", "left").select(
        "doc_id", F.when(F.col("early"), "red blue").otherwise("green yellow").alias("text"), F.lit(True).alias("t")
    )
    held = spark.createDataFrame([(10_000, "green yellow", False)], "doc_id long, text string, t boolean")
    got = {r.doc_id: r for r in attention_lm.scored(train.unionByName(held), "t").collect()}
    assert len(got) == 3001
    assert got[10_000].score > -1.0 > got[10_000].base_score
