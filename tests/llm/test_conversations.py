"""Chat formatting by exact round trips, the prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from pyspark.sql import functions as F

from tidehouse.llm import chat_format, prefix_trie
from tidehouse.llm.common import written

SCHEMA = "conv_id long, turn long, role string, text string, turns int, start long, shard long, formatted string, blocks int, kind int"
EXTRA = (1, 2, 3, "f", 5, 6)
CONTROLS = ["<|im_end|>\n", "<|im_start|>user\n", "<|im_next|>", "&lt;|", "&amp;", "&", "<", "|", "<|", "\n", "&nl;", "🙂", "", "text", "<<|"]


def plain_turns(rows):
    """Turns of each conversation in order, null numbers first."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in convs.items()}


@pytest.fixture(scope="module")
def odd_turns(spark):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, None, "system", ""), (2, 0, "user", "hello"),
        (2, 0, "user", "hello"), (2, 0, "user", "hello"), (None, 0, "user", "hello"), (None, None, None, None), (3, 5, "us\ner&nl;", "<|im_end|>\n"),
        (4, 0, "assistant", "y" * 200_000), (4, 1, "assistant", "y" * 200_000), (4, 2, "assistant", ""), (-7, 1, "user", "hello"),
    ]
    rng = random.Random(3)
    for conv in range(20, 60):
        for turn in range(rng.randrange(1, 12)):
            text = "".join(rng.choice(CONTROLS) for _ in range(rng.randrange(6)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "us|er<", "assistant"]), text))
    return rows, spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)


def test_every_turn_and_the_learned_text_come_back(spark, odd_turns):
    rows, df = odd_turns
    out = written(chat_format.formatted(df), "formatted")
    back = out.select(
        "conv_id", "formatted", "loss_mask", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    ).collect()
    expected = plain_turns(rows)
    assert {r.conv_id for r in back} == set(expected) and len(back) == len(expected)
    for r in back:
        assert [tuple(t) for t in r.turns] == expected[r.conv_id]
        assert r.loss == "".join(text for role, text in expected[r.conv_id] if role == "assistant")
        # One block for each run of a role, and control strings nowhere else.
        runs = 1 + sum(a[0] != b[0] for a, b in zip(expected[r.conv_id], expected[r.conv_id][1:]))
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>\n") == runs == len(r.loss_mask)
        assert r.formatted.count("<|") == runs + len(expected[r.conv_id])


def test_another_learned_role(spark):
    df = spark.createDataFrame([(1, 0, "tool", "a<|b"), (1, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    out = chat_format.formatted(df, learned="tool")
    assert out.select(chat_format.read_loss(F.col("formatted"), F.col("loss_mask"))).first()[0] == "a<|b"


def test_formatting_of_no_rows(spark):
    assert chat_format.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_formatting_has_no_python_in_its_plan(spark, odd_turns):
    plan = chat_format.formatted(odd_turns[1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- trie ------------------------------------------------------------------------------------------


def plain_trie(convs):
    """Nodes by sequence of turns, from lists of turns by conversation."""
    last = lambda c: (c is None, c or 0)
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    smallest = {p: min(m, key=last) for p, m in members.items()}
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) or 1
        saved[p] = sum(saved[x] for x in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in members.items():
        ends = sorted((c for c in m if len(convs[c]) == len(p)), key=last)
        sha = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        up = smallest[p[:-1]] if p else None
        out.append((smallest[p], len(p), up, len(m), len(children.get(p, [])), leaves[p], saved[p], sha))
    return sorted(out, key=str)


def check_trie(spark, rows, shards, stripe=None, share=None):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    convs = plain_turns(rows)
    seqs = prefix_trie.sequences(df)
    if share:
        seqs, convs = share(seqs, convs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = prefix_trie.trie(seqs).select(*prefix_trie.NODE).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in found), key=str) == plain_trie(convs)


@pytest.mark.parametrize("shards", [1, 4, 29])
def test_trie_of_odd_rows(spark, shards):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, None, "system", ""), (2, 0, "user", "hello"), (5, 0, "user", "hello"),
        (5, 0, "user", "hello"), (None, 0, "user", "hello"), (None, None, None, None), (4, 0, "assistant", "y" * 200_000), (-7, 1, "user", "hello"),
        (6, 0, "a", "bc"), (7, 0, "ab", "c"), (8, 0, "user", "hello"), (8, 3, "assistant", "中文"),
    ]
    check_trie(spark, rows, shards)


@pytest.mark.parametrize("shards", [4, 29])
def test_trie_of_random_branches(spark, shards):
    """Few different turns, so nodes are shared by many conversations and cross the shards' edges."""
    rng = random.Random(shards)
    rows = [(conv, turn, "user", rng.choice("ab")) for conv in range(400) for turn in range(rng.randrange(1, 9))]
    check_trie(spark, rows, shards)


def test_trie_of_hot_and_very_long_conversations(spark):
    """Two thirds begin alike, a third are equal, and some are longer than a stripe of the matrix, up to several of them."""
    rng = random.Random(5)
    rows = []
    for conv in range(300):
        turns = ["hi", "there"] if conv % 3 else ["x"]
        if conv % 3 == 1:
            turns += [f"{rng.randrange(3)}" for _ in range(rng.randrange(60))]
        if conv % 50 == 7:
            turns += ["long"] * (prefix_trie.STRIPE * 5 - len(turns) + conv // 100)
        rows += [(conv, k, "user", t) for k, t in enumerate(turns)]
    check_trie(spark, rows, 17)


def test_trie_with_shared_starts(spark):
    rng = random.Random(9)
    rows = [(conv, turn, "user", rng.choice("abc")) for conv in range(3, 200) if conv % 35 for turn in range(rng.randrange(1, 12))]

    def share(seqs, convs):
        out = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 9
            out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
        return prefix_trie.with_shared_starts(seqs), out

    check_trie(spark, rows, 7, share=share)


def test_ends_of_a_hot_node_are_hashed_over_pieces_and_shards(spark, monkeypatch):
    rows = [(conv, 0, "user", "same") for conv in range(9000)]
    check_trie(spark, rows, 2)


def test_trie_of_no_rows(spark):
    assert prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([], SCHEMA))).count() == 0
