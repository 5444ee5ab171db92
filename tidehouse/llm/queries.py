"""One query for each training-data operator, with the parameters used in production, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    attention_lm, block_naming, chat_format, language_id, license_scan, line_dedup, mixing, packing, piecewise_hash, prefix_trie,
    resampling, simhash, toxicity,
)
from .common import id_bucket, table, written

Query = Callable[[SparkSession, str], DataFrame]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Target weights of the domains (the labels' quality).
MIX = {"high": 0.9, "low": 0.1}


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("domain"))


def op1_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 ids, filled by lexical neighbours."""
    out = packing.pack(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later occurrences of windows of three lines, or of three units of long lines."""
    out = line_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), long_words=line_dedup.LONG_WORDS)
    return out.select("doc_id", "text", F.col("_lines").alias("lines"), F.col("_lines_removed").alias("lines_removed"))


def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of all documents, learned from those with a remainder other than 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = attention_lm.scored(docs.withColumn("train", id_bucket("doc_id", 10) != 0), "train")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels of those with a remainder other than 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_bucket("doc_id", 4) == 2
    model = toxicity.learn(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    out = toxicity.scored(docs, model)
    score = F.col("toxicity")
    return out.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


def op5_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template matches of all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("matches")


def op6_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    return piecewise_hash.edited_likeness(table(spark, sf_dir, "documents"))


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of every document in a mix of nine parts of high and one part of low quality."""
    out = mixing.rates(table(spark, sf_dir, "documents"), domains(table(spark, sf_dir, "labels")), MIX)
    posterior = [F.coalesce(F.col("p")[k], F.lit(0.0)).alias(f"p_{name}") for k, name in enumerate(MIX)]
    return out.select("doc_id", "n_words", *posterior, "rate")


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents."""
    return block_naming.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 64-bit fingerprints differ in at most two bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those with a remainder other than 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket("doc_id", 3) == 1
    model = language_id.learn(docs.filter(~held_out))
    out = language_id.languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_regular_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents weighted towards the benchmark's words; a tenth of those with 20 words is drawn, in order."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation of control strings, formatted beside the table's own.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
CONTROL_TURNS = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings as texts with a loss mask, and digests of what is read back from them."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    out = written(chat_format.formatted(turns.unionByName(added)), "formatted")
    text = F.col("formatted")
    back = out.select(
        "conv_id", F.length(text).cast("long").alias("formatted_chars"), chat_format.read_turns(text).alias("turns"),
        chat_format.read_loss(text, F.col("loss_mask")).alias("loss"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, each branching off the first one of its five."""
    own = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_starts(own))


QUERIES: dict[str, Query] = {
    "op1_bm25_packing": op1_bm25_packing,
    "op2_line_windows": op2_line_windows,
    "op3_attention_lm": op3_attention_lm,
    "op4_toxic_lexicon": op4_toxic_lexicon,
    "op5_license_join": op5_license_join,
    "op6_piecewise_hash": op6_piecewise_hash,
    "op7_soft_mixing": op7_soft_mixing,
    "op8_block_naming": op8_block_naming,
    "op9_simhash_anchors": op9_simhash_anchors,
    "op10_ppm_language": op10_ppm_language,
    "op11_regular_sampling": op11_regular_sampling,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_prefix_trie": op13_prefix_trie,
}

#: The crc32 of text ``x``: a table of 256 entries by the polynomial, then one step for each byte.
_CRC_TABLE = """crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS k
    FROM range(256) r(i))"""


def _crc32(x: str) -> str:
    byte = f"('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT"
    steps = f"list_prepend(4294967295::BIGINT, [{byte} for i in range(strlen({x}))])"
    return f"xor(list_reduce({steps}, lambda c, b: xor(k[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"

ORACLE: dict[str, str] = {
    "op8_block_naming": f"""
        WITH t AS (SELECT doc_id, {_LOWERED} AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY x)
    """,
    "op11_regular_sampling": f"""
        WITH {_CRC_TABLE},
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_WORDS}') AS words FROM documents),
        dw AS (SELECT r, unnest(words) AS w FROM d),
        bw AS (SELECT unnest(regexp_extract_all({_LOWERED}, '{_WORDS}')) AS w FROM benchmark),
        words AS (SELECT w, {_crc32("w")} % 10000 AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
        s AS (SELECT b, count(*) AS n FROM dw JOIN words USING (w) GROUP BY b),
        t AS (SELECT b, count(*) AS n FROM bw JOIN words USING (w) GROUP BY b),
        sizes AS (SELECT (SELECT count(*) FROM dw) + 10000.0::DOUBLE AS s, (SELECT count(*) FROM bw) + 10000.0::DOUBLE AS t),
        gain AS (
            SELECT words.w, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * sizes.s / ((coalesce(s.n, 0) + 1.0::DOUBLE) * sizes.t)))::BIGINT AS g
            FROM words LEFT JOIN s USING (b) LEFT JOIN t USING (b), sizes),
        weights AS (SELECT r, sum(g)::BIGINT AS weight FROM dw JOIN gain USING (w) GROUP BY r),
        h AS (SELECT r, doc_id, len(words)::BIGINT AS n, coalesce(weight, 0) AS weight,
                     ('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT AS h
              FROM d LEFT JOIN weights USING (r)),
        scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM h),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY n >= 20) AS m FROM scored)
        SELECT doc_id, n AS n_words, n AS n_features, weight, score, CASE WHEN n >= 20 AND k <= 10 * m // 100 THEN k END AS rank FROM ranked
    """,
    "op12_chat_formatting": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
        o AS (
            SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
                   length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) AS chars,
                   length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;')) AS role_chars
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars + CASE WHEN before IS NULL OR before <> role
                                THEN length('<|im_start|>') + role_chars + 1 + length('<|im_end|>') + 1
                                ELSE length('<|im_next|>') END)::BIGINT AS formatted_chars
        FROM o GROUP BY conv_id
    """,
    "op13_prefix_trie": f"""
        WITH {_CRC_TABLE},
        own AS (
            SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
            FROM conversations GROUP BY conv_id),
        shared AS (SELECT c, turns, c - c % 5 AS base, ({_crc32("c::VARCHAR")} % 9)::BIGINT AS h FROM own, crc),
        built AS (
            SELECT s.c, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
            FROM shared s LEFT JOIN own b ON b.c = s.base),
        starts AS (SELECT c, len(turns) AS whole, unnest(range(0, len(turns) + 1)) AS depth, turns[1:depth] AS p FROM built),
        node AS (
            SELECT p, depth, min(c) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (whole = depth), '')) AS ends_sha256,
                   CASE WHEN depth = 0 THEN 0 ELSE strlen(p[depth].x) END AS bytes
            FROM starts GROUP BY p, depth),
        children AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1, 2),
        counted AS (SELECT node.*, coalesce(children.n, 0) AS n_children FROM node LEFT JOIN children USING (p, depth)),
        under AS (
            SELECT p[1:top] AS p, top AS depth, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM counted) GROUP BY 1, 2)
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM counted n JOIN under USING (p, depth) LEFT JOIN node up ON up.depth = n.depth - 1 AND up.p = n.p[1:n.depth - 1]
    """,
}
