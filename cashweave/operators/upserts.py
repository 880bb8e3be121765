"""Reference-data writes. Each returns the whole new table as a DataFrame.

Parquet has no MERGE, so the caller writes the result to a new path. Existing
rows are never rewritten row by row: they pass through an anti-join on the key.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from cashweave.functions.names import merchant_key, merchant_norm
from cashweave.operators.keyed import null_safe_join, one_per_key


def insert_ignore(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Add the rows whose key is new; the existing row wins."""
    added = null_safe_join(one_per_key(new, keys), existing.select(*keys), keys, "left_anti")
    return existing.unionByName(added, allowMissingColumns=True)


def duplicate_keys(new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that come with more than one distinct row."""
    return new.distinct().groupBy(*keys).count().where("count > 1").drop("count")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace; the new row wins. Two rows for one key are an error."""
    clash = duplicate_keys(new, keys).first()
    if clash is not None:
        raise ValueError(f"two different new rows for key {clash.asDict()}")
    rows = new.distinct()
    kept = null_safe_join(existing, rows.select(*keys), keys, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def replace_by(
    existing: DataFrame, new: DataFrame, scope: list[str], keys: list[str]
) -> DataFrame:
    """Drop existing rows whose scope occurs in the new rows, then add those.

    A blank key part equals a missing one.
    """
    named = {k: f"__key_{k}" for k in keys}
    keyed = new.withColumns(
        {named[k]: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys}
    )
    rows = one_per_key(keyed, list(named.values())).drop(*named.values())
    kept = existing.join(new.select(*scope).distinct(), scope, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def merchant_rows(names: DataFrame) -> DataFrame:
    """Dimension rows for a column ``merchant_name``."""
    return names.select(
        merchant_key(F.col("merchant_name")).alias("merchant_id"),
        "merchant_name",
        merchant_norm(F.col("merchant_name")).alias("merchant_name_norm"),
    )


def _present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.trim(column) != "")


def upsert_merchants(merchant: DataFrame, raw_sales: DataFrame) -> DataFrame:
    """Merchants named in the sales feed; the repayment feed adds none."""
    names = (
        raw_sales.where(_present("merchant"))
        .select(F.trim("merchant").alias("merchant_name"))
        .distinct()
    )
    return insert_ignore(merchant, merchant_rows(names), ["merchant_name"])


def upsert_skus(sku: DataFrame, merchant: DataFrame, raw_sales: DataFrame) -> DataFrame:
    """Products of the sales feed under their merchant, matched by lower case."""
    named = (
        raw_sales.where(_present("sku_id"))
        .select(F.trim("sku_id").alias("sku_id"), F.lower(F.trim("merchant")).alias("name"))
        .distinct()
    )
    known = merchant.select(F.lower("merchant_name").alias("name"), "merchant_id")
    new = named.join(known, "name").select("sku_id", "merchant_id")
    return insert_ignore(sku, new, ["sku_id"])


def sku_coverage(sku: DataFrame, raw_sales: DataFrame) -> DataFrame:
    """How many products are known, and how many the sales feed names."""
    named = raw_sales.where(_present("sku_id")).agg(F.count_distinct(F.trim("sku_id")).alias("n"))
    return sku.agg(
        F.count(F.lit(1)).alias("ref_sku_count"), F.max(named.scalar()).alias("sales_sku_count")
    )


def add_rules(rules: DataFrame, new: DataFrame) -> DataFrame:
    """Rules whose (pattern, code) is not there yet."""
    return insert_ignore(rules, new, ["raw_pattern", "category_code"])


def add_bridge_rows(
    bridge: DataFrame, merchant: DataFrame, merchant_name: str, rows: list[tuple[str, str, str]]
) -> DataFrame:
    """Hand-written (note, product, account) rows for one known merchant."""
    literals = F.array(
        *[
            F.struct(
                F.lit(note).alias("note_id"),
                F.lit(sku).alias("sku_id"),
                F.lit(va).alias("va_number"),
            )
            for note, sku, va in rows
        ]
    )
    new = merchant.where(F.col("merchant_name") == merchant_name).select(
        F.inline(literals), "merchant_id"
    )
    return insert_ignore(bridge, new, ["note_id", "va_number", "sku_id"])


class MissingMerchantError(ValueError):
    """A mapped product has no known merchant; nothing may be written."""


class Mapping(NamedTuple):
    sku: DataFrame
    bridge: DataFrame


def validated_mapping(
    batch: DataFrame, raw_sales: DataFrame, raw_expected: DataFrame, merchant: DataFrame
) -> DataFrame:
    """Mapping rows with the merchant both feeds give for the product."""
    named = [
        feed.where(_present("sku_id") & _present("merchant")).select(
            F.trim("sku_id").alias("sku_id"), F.trim("merchant").alias("merchant_name")
        )
        for feed in (raw_sales, raw_expected)
    ]
    owners = named[0].union(named[1]).distinct().withColumn("name", F.lower("merchant_name"))
    known = merchant.select(F.lower("merchant_name").alias("name"), "merchant_id")
    # Owner and merchant first: both are one row per product, the batch is not.
    owned = owners.join(known, "name", "left").select("sku_id", "merchant_id")
    return (
        batch.where(_present("sku_id") & _present("va_number"))
        .select(
            F.nullif(F.trim("note_id"), F.lit("")).alias("note_id"),
            F.trim("sku_id").alias("sku_id"),
            F.trim("va_number").alias("va_number"),
        )
        .join(owned, "sku_id", "left")
        .select("note_id", "sku_id", "va_number", "merchant_id")
    )


def without_merchant(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("merchant_id").isNull())


def load_mapping(
    batch: DataFrame,
    raw_sales: DataFrame,
    raw_expected: DataFrame,
    merchant: DataFrame,
    sku: DataFrame,
    bridge: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Mapping:
    """Replace the bridge rows of the batch's products.

    Raises before anything is written when a row has no merchant or a product
    comes with two. The validated rows are used several times; ``stage`` may
    write them and give back what it wrote.
    """
    rows = stage(validated_mapping(batch, raw_sales, raw_expected, merchant))
    orphan = without_merchant(rows).first()
    if orphan is not None:
        raise MissingMerchantError(f"no merchant for mapped product {orphan['sku_id']!r}")
    skus = upsert(sku, rows.select("sku_id", "merchant_id"), ["sku_id"])
    return Mapping(skus, replace_by(bridge, rows, ["sku_id"], ["note_id", "va_number", "sku_id"]))


def mapping_counts(bridge: DataFrame) -> DataFrame:
    return bridge.agg(
        F.count(F.lit(1)).alias("mappings_loaded"),
        F.count_distinct("sku_id").alias("distinct_skus"),
    )
