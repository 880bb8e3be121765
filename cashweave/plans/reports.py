"""Reports over the marts and core tables. Sorting happens here, not inside marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cashweave.functions.money import round_cents
from cashweave.operators.existence import exists_in
from cashweave.plans.level2 import PREVIEW_COLUMNS
from cashweave.scratch import Kept, as_it_is


def _sales_gap() -> Column:
    return F.col("sales_proceeds") - F.col("amount_received")


def level1_top_variance(mart: DataFrame, n: int = 20) -> DataFrame:
    """Products whose sales and receipts differ most."""
    return (
        mart.orderBy(F.abs(_sales_gap()).desc(), "sku_id", F.asc_nulls_last("account_number"))
        .limit(n)
        .select(
            "sku_id",
            "merchant",
            *[
                round_cents(F.col(c)).alias(c)
                for c in ("amount_pulled", "amount_received", "sales_proceeds")
            ],
            round_cents(_sales_gap()).alias("variance_sales"),
        )
    )


def variance_overview(mart: DataFrame, n: int = 10) -> DataFrame:
    """Both variances of the products with the largest sales gap."""
    return (
        mart.orderBy(F.abs(_sales_gap()).desc(), "sku_id", F.asc_nulls_last("account_number"))
        .limit(n)
        .select(
            "sku_id",
            round_cents(F.col("amount_pulled") - F.col("amount_received")).alias("variance_cash"),
            round_cents(_sales_gap()).alias("variance_ui"),
            "merchant",
        )
    )


def level1_rows_for(mart: DataFrame, sku_id: str, account_number: str | None = None) -> DataFrame:
    """Point lookup by product, and account if given."""
    rows = mart.where(F.col("sku_id") == sku_id)
    return rows if account_number is None else rows.where(
        F.col("account_number") == account_number
    )


def merchant_rollup(mart: DataFrame, ordered: bool = True) -> DataFrame:
    """Totals per merchant, largest sales gap first."""
    rows = mart.groupBy("merchant").agg(
        round_cents(F.sum("amount_pulled")).alias("total_pulled"),
        round_cents(F.sum("amount_received")).alias("total_received"),
        round_cents(F.sum("sales_proceeds")).alias("total_sales"),
        F.abs(F.sum(_sales_gap())).alias("gap"),
    )
    return (rows.orderBy(F.desc("gap"), "merchant") if ordered else rows).drop("gap")


def in_report_order(mart: DataFrame) -> DataFrame:
    """Sorted by the leading key columns, as the reports are printed."""
    return mart.orderBy(
        *[
            F.asc_nulls_last(f"`{c}`")
            for c in mart.columns
            if c in ("sku_id", "SKU ID", "account_number", "Account Number", "va_number")
        ]
    )


def level2a_preview(mart: DataFrame, n: int = 100) -> DataFrame:
    """The main waterfall columns of the first products."""
    return (
        mart.orderBy(F.asc_nulls_last("SKU ID"), F.asc_nulls_last("Merchant"))
        .limit(n)
        .select(*PREVIEW_COLUMNS)
    )


def drilldown(
    level1: DataFrame, sales: DataFrame, level2a: DataFrame, like: str, kept: Kept = as_it_is
) -> DataFrame:
    """Level 1 next to the reported totals and the waterfall of the products
    whose id is LIKE the pattern.

    ``sales`` may be rows or totals. ``kept`` gets what is shown of either mart, so that
    each can be a job of its own.
    """
    wanted = F.col("sku_id").like(like)
    reported = (
        sales.where(wanted)
        .groupBy("sku_id")
        .agg(
            round_cents(F.sum("total_funds_inflow")).alias("csv_total_funds_inflow"),
            round_cents(F.sum("sales_proceeds")).alias("csv_sales_proceeds"),
        )
    )
    buckets = [c for c in PREVIEW_COLUMNS if c.endswith(" Paid")]
    waterfall = level2a.select(
        F.col("SKU ID").alias("sku_id"),
        F.col("Amount Received").alias("l2a_amount_received"),
        reduce(lambda a, b: a + b, [F.col(c) for c in buckets]).alias("l2a_total_paid"),
        "Fund Transferred to Other SKU",
        "Fund Transferred from Other SKU",
    ).where(wanted)
    cash = level1.where(wanted).select("sku_id", "amount_pulled", "amount_received", "sales_proceeds")
    return (
        kept(cash, "drilldown-cash")
        .join(kept(reported, "drilldown-reported"), "sku_id", "left")
        .join(kept(waterfall, "drilldown-waterfall"), "sku_id", "left")
        .select(
            "sku_id",
            "csv_total_funds_inflow",
            "csv_sales_proceeds",
            "amount_pulled",
            "amount_received",
            "sales_proceeds",
            "l2a_amount_received",
            "l2a_total_paid",
            "Fund Transferred to Other SKU",
            "Fund Transferred from Other SKU",
        )
    )


def _tagged_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def raw_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, by table name."""
    return _tagged_counts(tables).orderBy("tbl")


def total_rows(tables: dict[str, DataFrame]) -> DataFrame:
    return _tagged_counts(tables).agg(F.sum("cnt").alias("total_rows"))


def chain_status(
    bridge: DataFrame, external: DataFrame, sales: DataFrame, txn: DataFrame, level1: DataFrame
) -> DataFrame:
    """Row counts along the chain, side by side. txn: ledger rows, or their counts (``n``)."""
    counted = _tagged_counts(
        {"map_rows": bridge, "external_rows": external, "sales_rows": sales, "level1_rows": level1}
    )
    repaid = txn.where(F.col("category_code") == "merchant_repayment")
    n = F.coalesce(F.sum("n"), F.lit(0)) if "n" in txn.columns else F.count(F.lit(1))
    inflows = repaid.agg(n.alias("cnt")).select(F.lit("inflow_rows").alias("tbl"), "cnt")
    counts = counted.unionByName(inflows)
    names = ["map_rows", "external_rows", "sales_rows", "inflow_rows", "level1_rows"]
    return counts.agg(
        *[F.max(F.when(F.col("tbl") == name, F.col("cnt"))).alias(name) for name in names]
    )


def remark_audit(raw_ledger: DataFrame, n: int = 50) -> DataFrame:
    """The most frequent remarks, to spot unmapped variants."""
    return (
        raw_ledger.groupBy(F.lower("remarks").alias("remark"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("remark"))
        .limit(n)
    )


def top_pulled(external: DataFrame, n: int = 20) -> DataFrame:
    """Accounts with the largest pulls; accounts without an amount come first."""
    return (
        external.groupBy("va_number")
        .agg(F.sum("buy_amount").alias("pulled"))
        .orderBy(F.desc_nulls_first("pulled"), F.asc_nulls_last("va_number"))
        .limit(n)
    )


def mapping_report(bridge: DataFrame, external: DataFrame) -> DataFrame:
    """Bridge rows and whether the bank feed knows the account."""
    return exists_in(bridge, external, "va_number")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any few rows."""
    return df.limit(n)


def level1_count(mart: DataFrame) -> DataFrame:
    return mart.agg(F.count(F.lit(1)).alias("level1_rows"))


def level1_count_if_defined(spark, view: str = "v_level1") -> DataFrame | None:
    """Row count of the published mart, or None where it is not defined."""
    return level1_count(spark.table(view)) if spark.catalog.tableExists(view) else None
