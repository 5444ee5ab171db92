"""From documents to packed sequences: five stages, each one operator of ``tidehouse.llm``, each written before the next reads it.

Every stage but the last returns the columns of ``documents``. SQL can express neither the learned stages nor the components, so
there is no SQL for the whole; the tests hold each stage against a plain version on a small fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehouse.llm import line_dedup, mixing, packing, simhash, toxicity
from tidehouse.llm.common import free_name, table, written
from tidehouse.llm.queries import MIX, domains

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.3, learned from the labels of the documents at hand."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_toxicity")
    return toxicity.scored(docs, model, score).filter(F.col(score) < 0.3).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three lines, or units of long lines; a document that loses all its lines goes."""
    out = line_dedup.without_repeats(docs, long_words=line_dedup.LONG_WORDS)
    out = out.filter("_lines = 0 OR _lines_removed < _lines")
    length = F.when(F.col("_lines_removed") + F.col("_lines_cut") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarities of 0.8 or more on shingles of five words.

    Candidates are pairs within 64 of 256 bits: a similarity of 0.8 means 39 different bits on average, with a deviation of 5.5.
    """
    return simhash.without_near_duplicates(docs, width=5, n_words=4, tables=simhash.SIX_TABLES, max_bits=64, least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that bring high and low quality to their target weights."""
    return mixing.mixed(docs, domains(table(spark, sf_dir, "labels")), MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids; in little memory, since executors have four stages behind them."""
    return packing.pack(docs, chunk_bytes=1 << 20, remembered=300_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
