"""Exact duplicates, SimHash neighbours and piecewise hashes against plain versions."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tidehouse.llm import block_naming, components, piecewise_hash, simhash

ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return (text or "").encode().translate(ASCII)


def check_exact(rows, docs):
    texts = docs.select("doc_id", "text").collect()
    groups = {}
    for i, t in texts:
        groups.setdefault(normal(t), []).append(i)
    assert len(rows) == len(texts)
    digests = {hashlib.sha256(t).hexdigest(): ids for t, ids in groups.items()}
    kept = {}
    for r in rows:
        ids = digests[r.text_sha256]
        assert r.group_size == len(ids) and r.doc_id in ids
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


def test_exact_duplicates_of_odd_rows(odd_docs):
    check_exact(block_naming.exact_duplicates(odd_docs).collect(), odd_docs)


def test_exact_duplicates_with_small_blocks(docs):
    """Many levels of names, and blocks that documents share."""
    check_exact(block_naming.exact_duplicates(docs, block_bytes=16).collect(), docs)


def test_exact_duplicates_of_a_hot_text(spark):
    rows = [(k, "the same text in two thirds of all rows " * 20 if k % 3 else f"text {k}") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check_exact(block_naming.exact_duplicates(df, block_bytes=64).collect(), df)


def test_exact_duplicates_of_no_rows(no_docs):
    assert block_naming.exact_duplicates(no_docs).count() == 0


def plain_print(text, width, seed=42):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), seed) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, prints, max_bits):
    """Component of each id over all pairs."""
    label = dict.fromkeys(ids)
    order = sorted({(p, i) for p, i in zip(prints, ids)})
    parent = {x: x for x in order}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if ((a[0] ^ b[0]) % (1 << 64)).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)), key=lambda v: v[1])
                parent[y] = x
    for p, i in zip(prints, ids):
        root = find((p, i))
        label[i] = min(j for q, j in order if find((q, j)) == root)
    return label


def test_simhash_against_all_pairs(docs):
    rows = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_print(t, 3) for i, t in rows.items()}
    expected = smallest_reachable(list(prints), list(prints.values()), 2)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.f0 % (1 << 64) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == expected


def test_links_of_planted_fingerprints(spark):
    """Chains and clusters of fingerprints, also a dense one, against all pairs."""
    rng = np.random.default_rng(3)
    values = []
    for _ in range(40):
        at = int(rng.integers(-(1 << 63), 1 << 63))
        for _ in range(12):
            values.append(at)
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                at ^= (1 << int(b)) - (1 << 64) * int(b == 63)
    dense = int(rng.integers(-(1 << 63), 1 << 63))
    values += [dense ^ (1 << b) for b in range(63)]
    values = sorted(set(values))
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id long, f0 long")
    found = components.components(simhash.near_links(df, simhash.PAIR_TABLE, 2, 2)).collect()
    got = {r.node: r.component for r in found}
    expected = smallest_reachable(list(range(len(values))), values, 2)
    assert {k: got.get(k, k) for k in expected} == expected


def test_anchors_cover_every_pair_in_reach():
    rng = np.random.default_rng(4)
    for errors in ([], [0], [5, 30], [44, 45]):
        x = int(rng.integers(0, 1 << 46))
        y = x
        for b in errors:
            y ^= 1 << b
        words = [np.array([x, y], dtype=np.int64)]
        at = {0: set(), 1: set()}
        home = {}
        for rows, anchors, is_home in simhash.visits(words, ((0, 0), (0, 23)), 2):
            for r, a in zip(rows.tolist(), anchors.tolist()):
                at[r].add(a)
                if is_home:
                    home[r] = a
        assert home[0] in at[1] and home[1] in at[0]


def test_simhash_of_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.component_id for r in rows if r.f0 == 0 and r.doc_id is not None}
    assert empty == {1}
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.without_near_duplicates(odd_docs, 5, 4, simhash.FOUR_TABLES, 50)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and len(set(ids)) == len(ids) - 1
    assert [r.text for r in kept.collect() if r.doc_id == 12] == ["Another text of the same id."]


def test_near_copies_go_and_others_stay(spark):
    """Two words in a hundred replaced: a similarity of about 0.8 on shingles of five words."""
    rng = np.random.default_rng(5)
    rows, copies = [], set()
    for k in range(60):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        rows.append((2 * k, " ".join(words)))
        if k % 2:
            for at in rng.choice(300, 5, replace=False):
                words[at] = "changed"
            rows.append((2 * k + 1, " ".join(words)))
            copies.add(2 * k + 1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.without_near_duplicates(df, 5, 4, simhash.FOUR_TABLES, 50).collect()}
    assert kept == {i for i, _ in rows} - copies


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert {got[k] for k in range(201)} == {0}
    assert {got[1000 + k] for k in range(300)} == {1000} and got[5000] == 5000
    assert components.components(df.limit(0)).count() == 0


def check_edited(docs):
    rows = [(i, t or "") for i, t in docs.select("doc_id", "text").collect()]
    got = piecewise_hash.edited_likeness(docs).collect()
    assert len(got) == len(rows)
    return rows, got


def test_piecewise_against_a_plain_sort(docs):
    rows, got = check_edited(docs)
    rows.sort(key=lambda r: -r[0])
    found = {r.doc_id: r for r in got}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        tail = len(text) // 3
        edited = text[: len(text) - tail] + following[:tail]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == piecewise_hash.fingerprint(text.encode())
        assert r.edited_fingerprint == piecewise_hash.fingerprint(edited.encode())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    long = [r for r in got if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > 0.45 > 0.1 > np.mean([r.near_next for r in long])


def test_piecewise_of_odd_rows(odd_docs, no_docs, spark):
    rows, got = check_edited(odd_docs)
    same = {}
    for r in got:
        same.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in same.values())
    assert piecewise_hash.edited_likeness(no_docs).count() == 0
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert piecewise_hash.edited_likeness(one).first().edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400))
def test_piecewise_shape(text):
    size, one, two = piecewise_hash.fingerprint(text).split(":")
    assert int(size) >= 4 and len(one) <= 64 and len(two) <= 64
    assert (not text) == (one == "")


def test_similarity_decides_near_copies(spark):
    """Pairs at 0.6, 0.7, 0.79, 0.81 and 0.9, a hot family, and texts of one fingerprint: the groups of brute force."""
    rng = np.random.default_rng(6)
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words)))

    for likeness in (0.6, 0.7, 0.79, 0.81, 0.9) * 8:
        words = [f"w{x}" for x in rng.integers(0, 1 << 40, 2000)]
        add(words)
        # An exchanged tail of m of n shingles leaves (n - m) / (n + m).
        m = round(1996 * (1 - likeness) / (1 + likeness))
        add(words[: 2000 - m] + [f"v{x}" for x in rng.integers(0, 1 << 40, m)])
    base = [f"w{x}" for x in rng.integers(0, 1 << 40, 400)]
    for _ in range(60):
        words = list(base)
        for at in rng.choice(400, 8, replace=False):
            words[at] = f"v{rng.integers(0, 1 << 40)}"
        add(words)
    add("a b c d e f".split() * 100)
    add("a b c d e f".split() * 100 + ["g"])
    sets = {i: set(simhash.shingles(t.encode(), 5).tolist()) for i, t in rows}
    component = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(component[i], component[j]), min(component[i], component[j])
                component = {k: new if c == old else c for k, c in component.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df, 5, 4, simhash.SIX_TABLES, 2, 64, 0.8).collect()}
    assert got == component
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()}
    assert kept == {i for i, c in component.items() if i == c}


def test_a_chain_over_a_fingerprint_of_null_ids_alone(spark, monkeypatch):
    """5 - null - 8, one bit each: one component, and a null one apart stays null."""
    rows = [(5, 0), (None, 1), (8, 3), (None, 0xFFFF00), (None, 0xFFFF00)]
    prints = spark.createDataFrame([(i, k, f) for k, (i, f) in enumerate(rows)], "doc_id long, tie long, f0 long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, width, n_words: prints)
    found = sorted(((r.tie, r.component_id) for r in simhash.near_duplicates(prints).collect()))
    assert found == [(0, 5), (1, 5), (2, 5), (3, None), (4, None)]
