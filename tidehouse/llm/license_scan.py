"""License scans: an exact set-similarity join of text blocks with licence templates, with DataFrame functions only.

A block is a line; its words are runs of ASCII letters (A-Z count as a-z), digits and other characters. A template matches a block
if the block contains at least ``threshold`` of the template's distinct words (containment). Words are ordered by their global
number of blocks, the rarest first. Since a match shares at least ``need = ceil(threshold * size)`` words,

* prefix filter: some shared word is among the template's first ``size - need + 1`` words;
* length filter: the block has at least ``need`` words of the templates' vocabulary (other words never match and are left out);
* positional filter: from the first shared word on, both sides must still have ``need`` words.

What passes is verified by the intersection itself, so nothing is lost and nothing is estimated. The templates are a parameter
of bounded size; the blocks of a document are never gathered beyond those that pass the length filter.

Apart from the join, the places of the base phrases in a document's whole word sequence are found. Null texts count as empty; null
ids and repeated rows are documents of their own; documents without words have no labels and score 0.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Phrases and labels of the base (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Characters between words: all ASCII characters but digits and small letters (fixed value).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license version 2 0"),
)
#: Words of a template that a match must have, whatever else it shares: they tell it from its look-alikes.
TELLING = {
    "licensed under the apache license version 2 0": "apache",
    "licensed under cc by nc 4 0": "cc nc",
    "licensed under cc by sa 4 0": "cc sa",
    "this work is licensed under the gnu general public license version 3": "gnu general",
    "licensed under the gnu lesser general public license version 3": "gnu lesser",
    "released under the mit license": "mit",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "mozilla",
}


def lowered(text: Column) -> Column:
    """Lower case of A to Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def places(found: Column, phrase: str) -> Column:
    """Positions in a word array at which the phrase's words stand consecutively."""
    parts = phrase.split()
    last = F.size(found) - len(parts)

    def matches(i: Column) -> Column:
        same = F.lit(True)
        for k, part in enumerate(parts):
            same = same & (F.element_at(found, i + 1 + k) == part)
        return same

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), matches)).otherwise(F.array().cast("array<int>"))


def template_rows(templates: tuple[tuple[str, str], ...], threshold: float) -> list[tuple[int, str, list[str], int]]:
    """(number, label, distinct words, words needed) of each template."""
    rows = [(n, label, sorted(set(text.split()))) for n, (label, text) in enumerate(templates)]
    return [(n, label, w, math.ceil(threshold * len(w) - 1e-9)) for n, label, w in rows]


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, telling: dict[str, str] | None = None
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matched blocks.

    ``telling`` has, by template, words that its matches need besides the containment (without it ``TELLING``).

    ``score`` is 1 with a base phrase, else the largest containment of a match, else 0. ``blocks`` lists the matches as
    (line, label, containment).
    """
    spark = docs.sparkSession
    rows = template_rows(templates, threshold)
    needed = [(TELLING if telling is None else telling).get(template, "").split() for _, template in templates]
    vocabulary = F.array(*(F.lit(w) for w in sorted({w for *_, ws, _ in rows for w in ws})))
    least = min(need for *_, need in rows)
    text = lowered(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # The one-element explode computes text and words once for each row; elsewhere they would be computed for each use.
    parts = F.struct(text.alias("text"), words(text).alias("words"))
    rows_of = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.explode(F.array(parts)).alias("own"))
    text, all_words = F.col("own.text"), F.col("own.words")

    lines = F.split(text, "\n")
    sets = F.transform(lines, lambda line: F.array_intersect(words(line), vocabulary))
    lowercase = docs.select(F.explode(F.array(F.struct(lowered(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")))).alias("own"))
    counts = lowercase.select(F.explode(sets).alias("set")).select(F.explode("set").alias("word"))
    # At most one row for each word of the templates.
    counts = counts.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rank = {w: k for k, (w, n) in enumerate(sorted(((r[0], r[1]) for r in counts.collect()), key=lambda x: (x[1], x[0])))}
    rarest_first = [sorted(ws, key=lambda w: (rank.get(w, -1), w)) for *_, ws, _ in rows]
    order = [w for w in sorted({w for ws in rarest_first for w in ws}, key=lambda w: (rank.get(w, -1), w))]
    index = spark.createDataFrame(
        [(w, n, label, ws, needed[n], need, at) for (n, label, _, need), ws in zip(rows, rarest_first) for at, w in enumerate(ws[: len(ws) - need + 1])],
        T.StructType.fromDDL("word string, template int, label string, words array<string>, telling array<string>, need int, at int"),
    )

    # Few documents have any phrase: the word-by-word search runs behind a search of the text.
    gates = {phrase: text.rlike(SEPARATORS.join(phrase.split())) for phrase in BASE}
    base = rows_of.select(
        "row", "doc_id",
        F.size(all_words).cast("long").alias("n_words"),
        F.create_map(*(x for phrase, label in BASE.items() for x in (F.lit(label), F.when(gates[phrase], places(all_words, phrase)).otherwise(F.array().cast("array<int>"))))).alias("places"),
        F.filter(
            F.transform(lines, lambda line, k: F.struct(k.alias("line"), F.array_intersect(F.array(*(F.lit(w) for w in order)), words(line)).alias("set"))),
            lambda block: F.size(block["set"]) >= least,
        ).alias("blocks"),
    )
    base = written(base, "license-blocks")

    blocks = base.select("row", F.explode("blocks").alias("block")).select("row", "block.line", "block.set")
    tokens = blocks.select("row", "line", "set", F.posexplode("set").alias("place", "word"))
    left_of_both = F.least(F.size("words") - F.col("at"), F.size("set") - F.col("place"))
    pairs = tokens.join(F.broadcast(index), "word").filter((F.size("set") >= F.col("need")) & (left_of_both >= F.col("need")))
    shared = F.size(F.array_intersect("words", "set"))
    told = F.size(F.array_except("telling", "set")) == 0
    matches = pairs.filter((shared >= F.col("need")) & told).select("row", "line", "label", (shared / F.size("words")).alias("containment"))
    # A row has at most its own matches, of at most as many labels as there are templates.
    found = matches.groupBy("row").agg(
        F.collect_set("label").alias("method"), F.max("containment").alias("containment"),
        F.array_sort(F.collect_set(F.struct("line", "label", "containment"))).alias("matches"),
    )
    every = F.flatten(F.map_values("places"))
    own = F.map_keys(F.map_filter("places", lambda _, p: F.size(p) > 0))
    out = base.join(found, "row", "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.coalesce("method", none))), ",").alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        "matches",
    )
