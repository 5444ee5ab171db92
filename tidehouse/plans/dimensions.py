"""Product dimension chain."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidehouse.operators.lookup import lookup


def category_levels(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """One row per lowest category with the names of all three levels."""
    levels = lookup(category3, category2, ["category2_id"], ["category3_id"])
    return lookup(levels, category1, ["category1_id"], ["category3_id"])


def with_product_names(
    rows: DataFrame, spu: DataFrame, trademark: DataFrame, levels: DataFrame, spread_by: list[str]
) -> DataFrame:
    """Rows with product ids, and the names that go with the ids."""
    named = lookup(rows, spu, ["spu_id"], spread_by)
    named = lookup(named, trademark, ["trademark_id"], spread_by)
    return lookup(named, levels, ["category3_id"], spread_by)


def flat_products(
    sku: DataFrame,
    spu: DataFrame,
    trademark: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
) -> DataFrame:
    """One row per sku with spu, trademark and the three category levels.

    The chain sku -> spu / trademark / category3 -> category2 -> category1 is walked once over the
    dimensions, so the much larger facts need a single join. Missing rows leave nulls.
    """
    levels = category_levels(category3, category2, category1)
    return with_product_names(sku, spu, trademark, levels, ["sku_id"]).select(
        "sku_id", "spu_id", "spu_name", "trademark_id", "trademark_name", "category3_id",
        "category3_name", "category2_id", "category2_name", "category1_id", "category1_name",
    )


def with_product(
    facts: DataFrame, products: DataFrame, spread_by: list[str], small: bool | None = None
) -> DataFrame:
    """Facts with the product columns of their ``sku_id``."""
    return lookup(facts, products, ["sku_id"], spread_by, small=small)
