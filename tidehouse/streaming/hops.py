"""Hops between jobs: a log of committed batches, and streams that take each batch once.

A job writes every micro-batch to a folder of its own and then commits it: one small file named by the batch's number, which is
created once. A batch that is run again after its commit does nothing, so a committed folder never changes. The next job follows the
log, not the folders; the file source takes a file name once, so a batch reaches it once, however often either side starts again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.streaming import sinks
from tidehouse.streaming.stores import Folder

COMMITS = "hop string, batch long, path string, schema string"
_INPUT, _TRIMMED = "_input", "_trimmed"


def log_folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}-commits"


def _file(batch_id: int) -> str:
    return f"{batch_id:012d}.json"


def committed(spark: SparkSession, root: str, name: str) -> list[dict]:
    """The commits of a job whose batch is still there and has rows or at least their columns, in order."""
    folder = Folder(spark, log_folder(root, name))
    first = int(folder.text(_TRIMMED) or 0)
    commits = (json.loads(folder.text(n)) for n in folder.names() if n.endswith(".json") and int(n[:-5]) >= first)
    return [c for c in commits if c["schema"]]


def trim(spark: SparkSession, root: str, name: str, before: int) -> None:
    """Removes the folders of the batches before ``before``, which every follower must have taken. Their commits stay, so a batch
    that is run again still does nothing; where the job writes a change log, its ``log_store`` still has the table."""
    log = Folder(spark, log_folder(root, name))
    lines = [json.loads(log.text(n)) for n in log.names() if n.endswith(".json") and int(n[:-5]) < before]
    log.create(_TRIMMED, str(max(before, int(log.text(_TRIMMED) or 0))), replace=True)
    for line in lines:
        parent, _, own = line["path"].rpartition("/")
        Folder(spark, parent).remove(own)


def committing(spark: SparkSession, root: str, name: str, write: sinks.BatchWriter, path: str | None = None) -> sinks.BatchWriter:
    """``write`` with a commit of the batch's folder below ``path`` (``<root>/<name>``) behind it."""
    at = path or f"{root.rstrip('/')}/{name}"

    def once(batch: DataFrame, batch_id: int) -> None:
        log = Folder(spark, log_folder(root, name))
        if log.text(_file(batch_id)) is not None:
            return
        write(batch, batch_id)
        own = sinks.batch_folder(at, batch_id)
        # A folder cut by a column has no file, and so no schema, where there are no rows.
        some = any(not n.startswith("_") for n in Folder(spark, own).names())
        schema = spark.read.parquet(own).schema.json() if some else None
        log.create(_file(batch_id), json.dumps({"hop": name, "batch": batch_id, "path": own, "schema": schema}))

    return once


def read_committed(spark: SparkSession, commits: Sequence[dict], schema: T.StructType) -> DataFrame:
    """The rows of the named batches; none gives no rows."""
    if not commits:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[c["path"] for c in commits])


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All committed rows of a job, with the number of their ``batch``."""
    commits = committed(spark, root, name)
    schema = T.StructType.fromJson(json.loads(commits[0]["schema"]))
    paths = [c["path"] for c in commits]
    return spark.read.schema(schema).option("basePath", paths[0].rsplit("/", 1)[0]).parquet(*paths)


def follow(spark: SparkSession, root: str, name: str, batches_at_once: int | None = None) -> DataFrame:
    """The commits of a job as a stream, for ``each_batch``; the job must have committed something."""
    reader = spark.readStream.schema(COMMITS)
    if batches_at_once:
        reader = reader.option("maxFilesPerTrigger", batches_at_once)
    return reader.json(f"{log_folder(root, name)}/*.json")


def is_hop(stream: DataFrame) -> bool:
    return stream.schema.names == [f.split()[0] for f in COMMITS.split(", ")]


def merged(streams: Sequence[DataFrame]) -> DataFrame:
    """Streams of rows and of commits as one, each row with the number of its stream."""
    out = None
    for k, stream in enumerate(streams):
        own = [F.struct(*stream.columns).alias(f"_row{k}")]
        one = stream.select(F.lit(k).alias(_INPUT), *own)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def each_input(
    spark: SparkSession, root: str, names: Sequence[str], streams: Sequence[DataFrame], write: Callable[..., None]
) -> sinks.BatchWriter:
    """A writer of batches of ``merged(streams)``: ``write(*inputs, batch_id)`` gets the rows of each stream, or of its committed
    batches. ``names`` are those of the streams."""

    def split(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            inputs = []
            for k, (name, stream) in enumerate(zip(names, streams)):
                rows = held.filter(F.col(_INPUT) == k).select(f"_row{k}.*")
                if is_hop(stream):
                    # One line for each batch of the job before that has been committed since.
                    commits = [r.asDict() for r in rows.filter("schema IS NOT NULL").collect()]
                    schema = (commits or committed(spark, root, name))[0]["schema"]
                    rows = read_committed(spark, commits, T.StructType.fromJson(json.loads(schema)))
                inputs.append(rows)
            write(*inputs, batch_id)
        finally:
            held.unpersist()

    return split
