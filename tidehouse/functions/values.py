"""Casting, arithmetic, JSON and string helpers for string-typed change records."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidehouse.schemas import STRING_MAP

MONEY = "decimal(16,2)"


def field(record: Column, key: str) -> Column:
    """Value of ``key`` in a string map, null when absent."""
    return record[key]


def fields(record: Column, keys: list[str]) -> list[Column]:
    return [record[key].alias(key) for key in keys]


def has_key(record: Column, key: str) -> Column:
    """True when the map carries ``key``, also with a null value; false for a null map."""
    return F.coalesce(F.map_contains_key(record, key), F.lit(False))


def changed(old_json: Column, key: str) -> Column:
    """True when the raw JSON of the previous values mentions ``key``."""
    return has_key(F.from_json(old_json, STRING_MAP), key)


def as_int(text: Column) -> Column:
    return text.try_cast("int")


def amount(quantity: Column, price: Column) -> Column:
    """quantity x price on two-decimal numbers, as text with four decimals."""
    return (quantity.try_cast(MONEY) * price.try_cast(MONEY)).cast("string")


def money(text: Column) -> Column:
    """Exact number of an amount text, so that sums do not depend on the order of rows."""
    return text.try_cast("decimal(20,4)")


def first_token(text: Column, separator: str = " ") -> Column:
    return F.split_part(text, F.lit(separator), F.lit(1))


def json_keys(text: Column) -> Column:
    return F.json_object_keys(text)


WORD = "([a-z0-9]+|[一-龥])"


def words(text: Column) -> Column:
    """Runs of Latin letters and digits, and each Chinese character on its own."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1))


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    """Makes ``LATERAL split_words(text)`` available in SQL: one row ``word`` per word."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(line STRING) RETURNS TABLE (word STRING) "
        f"RETURN SELECT explode(regexp_extract_all(lower(line), '{WORD}', 1)) AS word"
    )
