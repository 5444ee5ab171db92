"""SimHash near duplicates by anchor points of a covering code.

Fingerprint. Words (ASCII lower case, runs without white space) form shingles; bit j is 1 if it is set in over half of the
shingles' XXH64 values, repeats included. A text with fewer words than a shingle is one shingle; without words all bits are 0.

Anchors. The 23-bit Golay code is perfect: every word has exactly one codeword within 3 bits, its home. A table covers one or
two 23-bit fields of a fingerprint by the code, or its square, whose codewords are the anchors. If x and y differ in at most
``reach`` bits of the fields, y lies within 3 + e bits of x's home in each field, the excesses e adding up to at most ``reach``.
So each fingerprint goes to every anchor within that distance, and each anchor compares its residents (those at home) with all
that came. Every pair within ``reach`` meets; residents of no common anchor are never compared.

Links are kept as they are found: an anchor reports each fingerprint with the smallest one it is connected to there, one row
for each fingerprint instead of all pairs. Equal fingerprints are one row from the start, so copies add nothing.

With ``least`` the anchors only make candidates, and a link is a pair whose distinct shingles have that Jaccard similarity. An
anchor first reports each row with its nearest smaller one, one row for each; these are compared, and what they link are groups.
Then all further candidates that lie in different groups are compared, so pairs inside a large family of copies are not counted
out and no candidate is left out.

Null texts count as empty and null ids as rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, partitions, text_bytes, text_chunks, written
from .components import components

#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0b110001110101
#: (word, lowest bit) of each field of a table.
Fields = tuple[tuple[int, int], ...]
PAIR_TABLE: tuple[Fields, ...] = (((0, 0), (0, 23)),)
FOUR_TABLES: tuple[Fields, ...] = (((0, 0),), ((0, 23),), ((1, 0),), ((1, 23),))
SIX_TABLES: tuple[Fields, ...] = (*FOUR_TABLES, ((2, 0),), ((2, 23),))


def _mixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Further hashes of the same shingles."""
    x = hashes + np.uint64(number * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 values of a text's shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    plain = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), (starts[width:] - 1).tolist())
    return np.array([digest(plain[i:j], seed) for i, j in spans], dtype=np.uint64)


def fingerprint(text: bytes, width: int, n_words: int = 1, seed: int = 42) -> list[int]:
    """64-bit numbers as signed integers; the first from XXH64 itself, the others from hashes derived from it."""
    return _print(shingles(text, width, seed), n_words)


def _print(hashes: np.ndarray, n_words: int) -> list[int]:
    if not len(hashes):
        return [0] * n_words
    out = []
    for number in range(n_words):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 4096):
            some = hashes[at : at + 4096]
            some = _mixed(some, number) if number else some
            bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        set_bits = (2 * ones > len(hashes)).astype(np.uint8)
        out.append(int(np.packbits(set_bits, bitorder="little").view(np.int64)[0]))
    return out


def _digest(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64))


def fingerprints(docs: DataFrame, width: int = 3, n_words: int = 1, with_sets: bool = False) -> DataFrame:
    """(doc_id, tie, f0, f1, ...) of every row of ``docs`` (doc_id, text); ``tie`` is a hash of the text.

    ``with_sets`` adds ``size`` and ``digest`` of the set of distinct shingles.
    """
    names = [f"f{k}" for k in range(n_words)] + ["size", "digest"] * with_sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            rows = []
            for text in text_bytes(batch["text"]):
                hashes = shingles(text, width)
                row = _print(hashes, n_words)
                if with_sets:
                    own = np.unique(hashes)
                    row += [len(own), _digest(own)]
                rows.append(row)
            words = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tie"], *words], names=["doc_id", "tie", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", "tie long", *(f"{n} long" for n in names)]))


@functools.cache
def _patterns() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Syndrome of each 23-bit word; and for excess 0, 1, 2 the differences from a word of a syndrome to its anchors.

    A level holds (first place by syndrome, count by syndrome, differences): all words of weight up to 3 + excess.
    """
    syndrome = np.zeros(1 << 23, dtype=np.uint16)
    basis = np.zeros(23, dtype=np.int64)
    for bit in range(23):
        rest = 1 << bit
        for top in range(bit, 10, -1):
            if rest >> top & 1:
                rest ^= GOLAY << (top - 11)
        basis[bit] = rest
        syndrome[1 << bit : 2 << bit] = syndrome[: 1 << bit] ^ np.uint16(rest)
    levels = []
    for weights in (range(4), (4,), (5,)):
        words = np.array([sum(1 << b for b in bits) for w in weights for bits in itertools.combinations(range(23), w)], dtype=np.int64)
        of = syndrome[words]
        order = np.argsort(of, kind="stable")
        count = np.bincount(of, minlength=2048)
        levels.append((np.cumsum(count) - count, count, words[order]))
    return syndrome, levels


def _near(field: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for the anchors at that excess of each row's field."""
    syndrome, levels = _patterns()
    first, count, words = levels[excess]
    of = syndrome[field]
    n = count[of]
    rows = np.repeat(np.arange(len(field)), n)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, field[rows] ^ words[first[of][rows] + within]


def visits(words: list[np.ndarray], fields: Fields, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(row, anchor, at home) by excess; the anchor is one codeword, or two side by side."""
    part = [(words[w].view(np.uint64) >> np.uint64(low)).astype(np.int64) & ((1 << 23) - 1) for w, low in fields]
    for excesses in itertools.product(range(min(reach, 2) + 1), repeat=len(fields)):
        if sum(excesses) > reach:
            continue
        rows, anchors = _near(part[0], excesses[0])
        for field, excess in zip(part[1:], excesses[1:]):
            more, second = _near(field[rows], excess)
            rows, anchors = rows[more], anchors[more] << 23 | second
        yield rows, anchors, not any(excesses)


def _spread(tables: tuple[Fields, ...], reach: int, n_words: int, carried: list[str]):
    names = ["anchor", "visitor", "id", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                ids = batch["id"].to_numpy()
                others = [batch[c].to_numpy() for c in carried]
                words = [batch[f"f{k}"].to_numpy() for k in range(n_words)]
                for number, fields in enumerate(tables):
                    for rows, anchors, home in visits(words, fields, reach):
                        columns = [anchors | number << 48, np.full(len(rows), not home), ids[rows], *(c[rows] for c in others)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def joined_up(ids: np.ndarray, words: list[np.ndarray], residents: int, max_bits: int) -> np.ndarray:
    """For each row of an anchor the smallest id it is connected to there; the first rows are the residents."""
    label = ids.copy()
    words = [w.view(np.uint64) for w in words]  # of signed numbers the absolute value's bits would count
    for k in range(residents):
        differing = sum(np.bitwise_count(w ^ w[k]) for w in words)
        near = np.flatnonzero(differing <= max_bits)
        if len(near) > 1:
            found = np.unique(label[near])
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    return label


def _whole_anchors(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """The columns in pieces that end where an anchor ends; rows come ordered by anchor."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        now = [batch[c].to_numpy(zero_copy_only=False) for c in names]
        last = np.searchsorted(now[0], now[0][-1]) if len(now[0]) else 0
        if last or (held and len(now[0]) and held[-1][0][-1] != now[0][0]):
            yield [np.concatenate(c) for c in zip(*held, [c[:last] for c in now])]
            held = []
        if len(now[0]):
            held.append([c[last:] for c in now])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _compare(n_words: int, max_bits: int):
    """Links of each anchor; rows come ordered by anchor, residents first."""

    def links(anchor: np.ndarray, visitor: np.ndarray, ids: np.ndarray, words: list[np.ndarray]) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        ends = np.append(starts[1:], len(anchor))
        homes = np.add.reduceat(~visitor, starts, dtype=np.int64)
        a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for k in np.flatnonzero((homes > 0) & (ends - starts > 1)):
            i, j = starts[k], ends[k]
            label = joined_up(ids[i:j], [w[i:j] for w in words], int(homes[k]), max_bits)
            moved = label != ids[i:j]
            if moved.any():
                a.append(label[moved])
                b.append(ids[i:j][moved])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in _whole_anchors(batches, ["anchor", "visitor", "id", *(f"f{k}" for k in range(n_words))]):
            yield links(done[0], done[1], done[2], done[3:])

    return run


def near_links(prints: DataFrame, tables: tuple[Fields, ...], reach: int, max_bits: int) -> DataFrame:
    """Links (a, b) that connect the ids of ``prints`` (id, f0, ...) as all pairs within ``max_bits`` would.

    Whole for pairs that differ in at most ``reach`` (0 to 2) bits of some table's fields.
    """
    n_words = len(prints.columns) - 1
    schema = ", ".join(["anchor long, visitor boolean, id long", *(f"f{k} long" for k in range(n_words))])
    n = partitions(prints.sparkSession)
    rows = prints.mapInArrow(_spread(tables, reach, n_words, [f"f{k}" for k in range(n_words)]), schema)
    rows = rows.repartition(n, "anchor").sortWithinPartitions("anchor", "visitor", "id")
    return rows.mapInArrow(_compare(n_words, max_bits), "a long, b long").distinct()


def _candidates(n_words: int, max_bits: int, least: float, nearest: bool):
    """Candidate pairs (a, b, nearest) of each anchor, smaller id first; rows come ordered by anchor, residents first.

    ``nearest``: of each row only the pair with the nearest smaller one, and (id, id, false) for every row that has others.
    Otherwise all pairs of different groups.
    """

    def pairs(ids: np.ndarray, groups: np.ndarray, sizes: np.ndarray, words: list[np.ndarray], residents: int) -> Iterator[tuple]:
        words = [w.view(np.uint64) for w in words]
        bits, to, degree = np.full(len(ids), 1 << 30), ids.copy(), np.zeros(len(ids), dtype=np.int64)
        for k in range(residents):
            differing = sum(np.bitwise_count(w ^ w[k]).astype(np.int64) for w in words)
            # The smaller set's share of the larger one bounds the similarity.
            close = (differing <= max_bits) & (groups != groups[k]) & (np.minimum(sizes, sizes[k]) >= least * np.maximum(sizes, sizes[k]) - 1e-6)
            near = np.flatnonzero(close)
            if not len(near):
                continue
            if not nearest:
                yield np.minimum(ids[near], ids[k]), np.maximum(ids[near], ids[k]), np.zeros(len(near), dtype=bool)
                continue
            degree[near] += 1
            degree[k] += len(near)
            larger = near[(ids[near] > ids[k]) & (differing[near] < bits[near])]
            bits[larger], to[larger] = differing[larger], ids[k]
            smaller = near[ids[near] < ids[k]]
            if len(smaller):
                best = smaller[np.argmin(differing[smaller])]
                if differing[best] < bits[k]:
                    bits[k], to[k] = differing[best], ids[best]
        if nearest:
            found = to != ids
            yield to[found], ids[found], np.ones(int(found.sum()), dtype=bool)
            # A row whose only pair is the one reported needs no second look; the other row of it counts its own pairs.
            more = degree > found
            yield ids[more], ids[more], np.zeros(int(more.sum()), dtype=bool)

    def links(anchor: np.ndarray, visitor: np.ndarray, ids: np.ndarray, groups: np.ndarray, sizes: np.ndarray, words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        ends = np.append(starts[1:], len(anchor))
        homes = np.add.reduceat(~visitor, starts, dtype=np.int64)
        held, n = [], 0
        for k in np.flatnonzero((homes > 0) & (ends - starts > 1)):
            i, j = starts[k], ends[k]
            for found in pairs(ids[i:j], groups[i:j], sizes[i:j], [w[i:j] for w in words], int(homes[k])):
                held.append(found)
                n += len(found[0])
                if n > 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["a", "b", "nearest"])
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["a", "b", "nearest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in _whole_anchors(batches, ["anchor", "visitor", "id", *_carried(n_words)]):
            yield from links(*done[:3], *done[3:5], done[5:])

    return run


def _carried(n_words: int) -> list[str]:
    return ["component", "size", *(f"f{k}" for k in range(n_words))]


def candidate_pairs(prints: DataFrame, tables: tuple[Fields, ...], reach: int, max_bits: int, least: float, nearest: bool) -> DataFrame:
    """Distinct (a, b, nearest) of ``prints`` (id, component, size, f0, ...): pairs within ``max_bits`` that meet at an anchor."""
    n_words = len(prints.columns) - 3
    carried = _carried(n_words)
    schema = ", ".join(["anchor long, visitor boolean, id long", *(f"{c} long" for c in carried)])
    rows = prints.mapInArrow(_spread(tables, reach, n_words, carried), schema)
    rows = rows.repartition(partitions(prints.sparkSession), "anchor").sortWithinPartitions("anchor", "visitor", "id")
    return rows.mapInArrow(_candidates(n_words, max_bits, least, nearest), "a long, b long, nearest boolean").distinct()


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, digest, own) with the sorted distinct shingles of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            own = [np.unique(shingles(x, width)).view(np.int64) for x in text_bytes(batch["text"])]
            digests = pa.array([_digest(x) for x in own], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], digests, pa.array(own, pa.list_(pa.int64()))], names=["id", "digest", "own"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, digest long, own array<long>")


def similar(docs: DataFrame, known: DataFrame, pairs: DataFrame, width: int, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts share at least ``least`` of their distinct shingles together (Jaccard).

    Of several texts of one id those count whose (id, digest) is in ``known``.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ends, "doc_id", "left_semi")
    sets = shingle_sets(rows, width).join(known.select("id", "digest"), ["id", "digest"], "left_semi")
    sets = written(sets.dropDuplicates(["id", "digest"]).select("id", "own"), "shingle-sets")
    left, right = sets.toDF("a", "own_a"), sets.toDF("b", "own_b")
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("own_a", "own_b")))
    union = F.size("own_a") + F.size("own_b") - F.col("shared")
    return both.filter((union == 0) | (F.col("shared") / union >= least)).select("a", "b").distinct()


def similar_groups(
    docs: DataFrame, width: int, n_words: int, tables: tuple[Fields, ...], reach: int, max_bits: int, least: float
) -> DataFrame:
    """(doc_id, tie, f0, ..., size, digest, component_id) of every row; links are pairs with a similarity of ``least`` or more.

    Rows with equal fingerprints and equal sets are one row in the comparison; a component of null ids alone has a null component_id.
    """
    prints = written(fingerprints(docs, width, n_words, with_sets=True), "prints")
    words = [f"f{k}" for k in range(n_words)]
    key = [*words, "size", "digest"]
    one = written(prints.groupBy(*key).agg(F.min("doc_id").alias("id")).select("id", *key), "distinct-prints")
    known = one.filter("id IS NOT NULL")

    rows = known.select("id", F.col("id").alias("component"), "size", *words)
    first = written(candidate_pairs(rows, tables, reach, max_bits, least, nearest=True), "candidates")
    tested = first.filter("nearest").select("a", "b")
    links = written(similar(docs, known, tested, width, least), "similar")
    labels = components(links).withColumnRenamed("node", "id")

    more = first.filter("NOT nearest").select(F.col("a").alias("id")).distinct()
    rows = known.join(more, "id", "left_semi").join(labels, "id", "left")
    rows = rows.select("id", F.coalesce("component", "id").alias("component"), "size", *words)
    rest = candidate_pairs(rows, tables, reach, max_bits, least, nearest=False).select("a", "b").join(tested, ["a", "b"], "left_anti")
    further = similar(docs, known, written(rest, "candidates"), width, least)
    labels = components(links.unionByName(further)).withColumnRenamed("node", "id")

    of = one.join(labels, "id", "left").select(*key, F.coalesce("component", "id").alias("component_id"))
    return prints.join(of, key)


def near_duplicates(
    docs: DataFrame, width: int = 3, n_words: int = 1, tables: tuple[Fields, ...] = PAIR_TABLE,
    reach: int = 2, max_bits: int = 2,
) -> DataFrame:
    """(doc_id, tie, f0, ..., component_id) of every row; the component is the smallest doc_id reachable over links.

    Fingerprints that only null ids have link like others; a component of null ids alone has a null component_id.
    """
    prints = written(fingerprints(docs, width, n_words), "prints")
    words = [f"f{k}" for k in range(n_words)]
    one = prints.groupBy(*words).agg(F.min("doc_id").alias("id")).select("id", *words)
    # Nodes are the smallest ids; fingerprints without one get numbers behind all ids, which never name a component.
    last = prints.agg(F.max("doc_id")).first()[0] or 0
    one = one.withColumn("id", F.coalesce("id", F.monotonically_increasing_id() + F.lit(last + 1)))
    one = written(one, "distinct-prints")
    labels = components(near_links(one, tables, reach, max_bits))
    labels = labels.select(F.col("node").alias("id"), "component")
    component = F.coalesce("component", "id")
    of = one.join(labels, "id", "left").select(*words, F.when(component <= last, component).alias("component_id"))
    return prints.join(of, words)


def without_near_duplicates(
    docs: DataFrame, width: int, n_words: int, tables: tuple[Fields, ...], max_bits: int, reach: int = 2, least: float = 0.8
) -> DataFrame:
    """Of each group of ``similar_groups`` the document with the smallest doc_id, with all columns of ``docs``.

    Different texts of one id that are not near each other but near nothing smaller are one group too; of these, and of
    repeated rows, the one with the smallest text hash stays. Null ids all stay.
    """
    groups = similar_groups(docs, width, n_words, tables, reach, max_bits, least)
    stay = groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.min("tie").alias("_tie"))
    stay = stay.withColumnRenamed("doc_id", "_stay")
    same = (docs["doc_id"].cast("long") == F.col("_stay")) & (F.xxhash64(docs["text"]) == F.col("_tie"))
    at = free_name(docs, "_at")
    rows = docs.join(stay, same, "left_semi").withColumn(at, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    return rows.filter(F.col(at) == 1).select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
