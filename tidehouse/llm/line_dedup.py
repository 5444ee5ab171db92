"""Line deduplication over windows of three lines.

Lines end at line feeds; blank lines are skipped, and white space around a line doesn't count. Three consecutive lines form a
window, windows overlap, and a window's identity is a 128-bit hash. Of all windows with one identity the first stays, by doc_id
(null ids last), then by text hash, then by position; the lines of all others are covered, and the covered lines of a document, merged,
are removed with the blank lines inside them. A document of fewer than three lines has no window and stays as it is.

With ``long_words`` prose is seen too: a line of more words is cut into units where the words themselves say so, behind a word whose
hash is the smallest of the three words before and after it. So a unit inside a line has four words or more, a passage is cut alike
wherever it stands, but for its first and last words, and three consecutive units form a window; other lines are one unit. Of a
line that loses some units the others stay. A word is a run without white space, or one character of the scripts without spaces.

A window that a third of all documents share is counted and reduced to its first place before the shuffle; the join that
finds its other places has one row on the small side, so run-time re-planning may split it. Null texts have no lines and
stay null. Rows of the same id and text count as one place: they lose the same lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, joined, released, span_hashes, text_bytes, text_chunks, written

#: Lines of more words are cut by the query and the stage.
LONG_WORDS = 12
_WINDOWS = "doc_id long, tie long, pos int, h1 long, h2 long"


def _units(texts: list[bytes], long_words: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line, start, end) of each unit; lines are numbered in each text, places are bytes in it."""
    buffer, begins = joined(texts)
    line_ends = np.flatnonzero(buffer == 0x0A)
    word = np.concatenate((~SPACE[buffer], np.zeros(3, dtype=bool)))
    # The first bytes of the three-byte characters from U+3000 to U+DFFF: one word each.
    single = np.concatenate(((buffer >= 0xE3) & (buffer <= 0xED), np.zeros(3, dtype=bool)))
    first = word & (single | np.concatenate(([True], ~word[:-1])) | np.concatenate((np.zeros(3, dtype=bool), single[:-3])))
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(word[:-1] & (~word[1:] | first[1:])) + 1
    line = np.searchsorted(line_ends, starts)
    new = np.concatenate(([True], line[1:] != line[:-1]))[: len(starts)]
    if long_words is not None and len(starts):
        lowest = np.ones(len(starts), dtype=bool)
        hashes = span_hashes(buffer, starts, ends)
        for k in range(1, 4):
            same = line[k:] == line[:-k]
            lowest[k:] &= ~same | (hashes[k:] < hashes[:-k])
            lowest[:-k] &= ~same | (hashes[:-k] <= hashes[k:])
            # Not beside a line's ends, where fewer words decide and units would be short.
            lowest[k:] &= same
            lowest[:-k] &= same
            lowest[:k] = lowest[len(lowest) - k :] = False
        many = np.bincount(line)[line] > long_words
        new[1:] |= (lowest & many)[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(starts))[: len(at)] - 1
    text = np.searchsorted(begins, starts[at], side="right") - 1
    return text, line[at] - np.searchsorted(line_ends, begins[text]), starts[at] - begins[text], ends[last] - begins[text]


def _windows(size: int, long_words: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            texts = text_bytes(batch["text"])
            of, _, starts, ends = _units(texts, long_words)
            units = [texts[k][i:j] for k, i, j in zip(of.tolist(), starts.tolist(), ends.tolist())]
            at = np.flatnonzero(of[size - 1 :] == of[: len(of) - size + 1]) if len(of) >= size else np.zeros(0, dtype=np.int64)
            digests = [xxhash.xxh3_128_digest(b"\n".join(units[k : k + size])) for k in at.tolist()]
            words = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            pos = (at - np.searchsorted(of, of[at])).astype(np.int32)
            owner_at = pa.array(of[at], pa.int64())
            columns = [batch["doc_id"].take(owner_at), batch["tie"].take(owner_at), pa.array(pos, pa.int32()), pa.array(words[:, 0]), pa.array(words[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _WINDOWS.split(", ")])

    return run


def _rebuild(text: str, covered: list[int], size: int, long_words: int | None) -> tuple[str, int, int, int]:
    """Text without the units of the windows that begin at ``covered``; lines there were, lines removed, and lines cut."""
    whole = text.encode()
    if not covered:
        # Lines with a word; where they are cut does not matter.
        return text, sum(1 for x in whole.split(b"\n") if x.strip()), 0, 0
    _, line, starts, ends = (x.tolist() for x in _units([whole], long_words))
    gone_units: set[int] = set()
    gone: set[int] = set()
    for at in covered:
        gone_units.update(range(at, at + size))
        gone.update(range(line[at], line[at + size - 1] + 1))
    kept: dict[int, list[list[int]]] = {}
    lost: set[int] = set()
    for k, at in enumerate(line):
        runs = kept.setdefault(at, [])
        if k in gone_units:
            lost.add(at)
        elif runs and runs[-1][2] == k - 1:
            runs[-1][1:] = [ends[k], k]
        else:
            runs.append([starts[k], ends[k], k])
    out, removed, cut = [], 0, 0
    for k, plain in enumerate(whole.split(b"\n")):
        if k in lost and kept[k]:
            out.append(b" ".join(whole[i:j] for i, j, _ in kept[k]))
            cut += 1
        elif k in lost:
            removed += 1
        elif k not in gone:
            out.append(plain)
    return b"\n".join(out).decode(), len(kept), removed, cut


def _keep(names: list[str], size: int, long_words: int | None):
    more = ["_lines", "_lines_removed"] + ["_lines_cut"] * (long_words is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            made = [
                (None, 0, 0, 0) if text is None else _rebuild(text, covered or [], size, long_words)
                for text, covered in zip(batch["text"].to_pylist(), batch["_covered"].to_pylist())
            ]
            texts, *counts = (list(c) for c in zip(*made))
            columns = [pa.array(texts, pa.string()) if name == "text" else batch[name] for name in names]
            columns += [pa.array(c, pa.int64()) for c in counts[: len(more)]]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *more])

    return run


def without_repeats(docs: DataFrame, size: int = 3, long_words: int | None = None) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...), ``text`` without later occurrences, and ``_lines``, ``_lines_removed``.

    With ``long_words`` longer lines are cut into units, and ``_lines_cut`` counts those that lost a part.

    Columns of ``docs`` that begin with an underscore are this operator's own and are replaced.
    """
    names = [c for c in docs.columns if c not in ("_lines", "_lines_removed", "_lines_cut", "_covered")]
    keyed = docs.select(*names).withColumn("text", F.col("text").cast("string"))
    tie = F.xxhash64("text").alias("tie")
    text = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), tie, "text")
    windows = text.mapInArrow(_windows(size, long_words), _WINDOWS)
    # Most windows stand once: half a hash and a count tell them, and only the others' places are sorted out.
    often = windows.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1")
    windows = written(windows.join(often, "h1", "left_semi").select("doc_id", "tie", "pos", "h1", "h2"), "repeated-windows")
    released(docs.sparkSession)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie", "pos")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    later = windows.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]).filter(F.col("first") != place)
    # At most as many positions as the document has units.
    covered = later.groupBy("doc_id", "tie").agg(F.array_sort(F.collect_set("pos")).alias("_covered"))
    covered = covered.toDF("_covered_id", "_covered_tie", "_covered")
    same = F.xxhash64(keyed["text"]).eqNullSafe(F.col("_covered_tie")) & keyed["doc_id"].cast("long").eqNullSafe(F.col("_covered_id"))
    both = keyed.join(covered, same, "left").select(*(keyed[c] for c in names), "_covered")
    more = ["_lines", "_lines_removed"] + ["_lines_cut"] * (long_words is not None)
    schema = T.StructType([*keyed.schema, *(T.StructField(c, T.LongType()) for c in more)])
    return both.mapInArrow(_keep(names, size, long_words), schema)
