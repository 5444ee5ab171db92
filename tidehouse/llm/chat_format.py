"""Chat formatting with Spark expressions only: sorted turn structs, merged runs of one role, concatenation, and a mask of the loss.

A conversation becomes one text. Adjacent turns of one role are one block, ``<|im_start|>role``, a line feed, its texts with
``<|im_next|>`` between them, ``<|im_end|>`` and a line feed. Inside roles and texts ``&`` is written ``&amp;`` and ``<|`` is written
``&lt;|``, inside roles a line feed is written ``&nl;``: no control string can stand there, and ``read_turns`` gives back every turn as it was.
``loss_mask`` has for each block the spans (start in the block, length, in code points of the formatted text) that are to be learned:
every text of the ``learned`` role, escapes included and control strings left out.

Turns are ordered by number, null first; equal numbers by role and text, null first. Null roles and texts count as empty, rows with a null id are one
conversation, repeated rows are turns of their own. An empty table gives an empty result; other columns are left out. A conversation
is one value, so it has to fit Spark's limit of 2 GB for a value; all else is spread by conversation. Apart from runs of one role,
work follows the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: control strings of the template and their escapes ---
START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
ESCAPES = (("&", "&amp;"), ("<|", "&lt;|"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&nl;"))
# --- end of fixed values ---


def _replaced(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column) -> Column:
    return _replaced(text, ESCAPES)


def unescaped(text: Column) -> Column:
    return _replaced(text, [(new, old) for old, new in reversed(ESCAPES)])


def _merged(run: Column, learned: str) -> Column:
    """One block of a run of turns of one role: its formatted text and the spans of its texts."""
    role = run[0]["role"]
    head = F.concat(F.lit(START), _replaced(role, ROLE_ESCAPES), F.lit("\n"))

    def add(block: Column, turn: Column) -> Column:
        text = escaped(turn["text"])
        before = F.concat(block["text"], F.when(F.size(block["spans"]) > 0, F.lit(NEXT)).otherwise(F.lit("")))
        span = F.struct(F.length(before).cast("long").alias("start"), F.length(text).cast("long").alias("length"))
        return F.struct(F.concat(before, text).alias("text"), F.concat(block["spans"], F.array(span)).alias("spans"))

    none = F.expr("CAST(array() AS array<struct<start:bigint,length:bigint>>)")

    def done(block: Column) -> Column:
        spans = F.when(role == learned, block["spans"]).otherwise(none)
        return F.struct(F.concat(block["text"], F.lit(END)).alias("text"), spans.alias("spans"))

    return F.aggregate(run, F.struct(head.alias("text"), none.alias("spans")), add, done)


def formatted(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_mask) of the conversations in ``turns`` (conv_id, turn, role, text)."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    # A run begins where the role differs from that of the turn before it, and ends where the next one begins.
    begins = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda k: (k == 1) | (F.element_at("turns", k)["role"] != F.element_at("turns", F.greatest(k - 1, F.lit(1)))["role"]),
    )
    ends = F.concat(F.slice("begins", 2, F.size("turns")), F.array(F.size("turns") + 1))
    runs = F.zip_with("begins", ends, lambda begin, end: F.slice("turns", begin, end - begin))
    blocks = F.transform(runs, lambda run: _merged(run, learned))
    out = sorted_turns.withColumn("begins", begins).select("conv_id", blocks.alias("blocks"))
    return out.select(
        "conv_id", F.array_join("blocks.text", "").alias("formatted"), F.col("blocks.spans").alias("loss_mask"),
    )


def _blocks(text: Column) -> Column:
    """The blocks of a formatted text, without their ends."""
    return F.filter(F.split(text, r"<\|im_end\|>\n"), lambda block: block != "")


def read_turns(text: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted text was made of."""

    def turns(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(START) + 1)), "\n", 1)
        body = F.substr(block, F.length(role) + F.lit(len(START) + 2))
        plain = _replaced(role, [(new, old) for old, new in reversed(ROLE_ESCAPES)])
        return F.transform(F.split(body, r"<\|im_next\|>"), lambda x: F.struct(plain.alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(_blocks(text), turns))


def read_loss(text: Column, mask: Column) -> Column:
    """All text under the mask, unescaped: what a model learns from."""

    def learned(block: Column, spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(block, s["start"] + 1, s["length"]))), "")

    return F.array_join(F.zip_with(_blocks(text), mask, learned), "")
