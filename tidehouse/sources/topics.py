"""Topics as DataFrames of lines: a message broker where its connector is present, else files.

A file topic is a folder of parquet files with a ``value`` column; every file is a batch of
messages. Null payloads (deletions in a keyed topic) are read as empty text.

With ``sequence`` the lines carry ``seq`` (at, part, pos), which orders them by arrival: a broker's
partition and offset (the records of a key share a partition), or a file's modification time and
name and the row in it. Put it behind the record's own time in every version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehouse.operators.records import clean_records
from tidehouse.schemas import CHANGE, CONFIG_CHANGE

LINE = T.StructType([T.StructField("value", T.StringType())])


def lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Payload text; null becomes empty."""
    return df.withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit("")))


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    streaming: bool = True,
    starting: str = "latest",
    files_per_batch: int | None = None,
    sequence: bool = False,
) -> DataFrame:
    """Lines of ``topic``: a topic name with ``servers``, else a folder of parquet lines."""
    reader = spark.readStream if streaming else spark.read
    if servers:
        raw = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting if streaming else "earliest")
            .load()
        )
        at = F.struct(
            F.lit(0).cast("long").alias("at"), F.col("partition").cast("string").alias("part"),
            F.col("offset").alias("pos"),
        )
        return lines(raw.select("value", at.alias("seq")) if sequence else raw.select("value"))
    reader = reader.schema(LINE)
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(topic)
    if sequence:
        at = F.struct(
            F.unix_micros("_metadata.file_modification_time").alias("at"),
            F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("pos"),
        )
        rows = rows.select("value", at.alias("seq"))
    return lines(rows)


def read_json_topic(
    spark: SparkSession, topic: str, schema: T.StructType, **options: object
) -> DataFrame:
    """Records of a JSON topic; malformed and empty lines are left out."""
    return clean_records(read_topic(spark, topic, **options), schema)


def change_records(line_df: DataFrame) -> DataFrame:
    """Change-log records of JSON lines, with the processing time ``pt``."""
    return clean_records(line_df, CHANGE).withColumn("pt", F.current_timestamp())


def config_records(line_df: DataFrame) -> DataFrame:
    """Configuration changes of JSON lines."""
    return clean_records(line_df, CONFIG_CHANGE)


def comma_lines(line_df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed columns of comma-separated lines; a field that cannot be read is null."""
    parts = F.split(F.col(value), ",")
    return line_df.select(
        *[
            F.try_element_at(parts, F.lit(i + 1)).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)
        ]
    )
