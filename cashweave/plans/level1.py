"""Level 1: cash pulled, received and sold per product and account."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cashweave.functions.money import or_zero
from cashweave.functions.parsing import TOTAL
from cashweave.operators.keyed import null_safe_join
from cashweave.operators.ledger import received

# The bridge is unique on these three, a missing part counting as a value.
BRIDGE_KEYS = ["sku_id", "va_number", "note_id"]


def universe(bridge: DataFrame, merchant: DataFrame) -> DataFrame:
    """Bridge rows with a known merchant: the grain of the report."""
    return bridge.join(merchant.select("merchant_id", "merchant_name"), "merchant_id").select(
        *BRIDGE_KEYS, "merchant_name"
    )


def first_rows(rows: DataFrame, group: str) -> DataFrame:
    """Keys of the first row of every group: the one that carries its total.

    Ordered by the other key, missing ones last, then by note. A minimum, not
    row_number(): it adds up per input split, so a group of any size is fine.
    """
    other = next(k for k in ("sku_id", "va_number") if k != group)
    order = F.struct(
        F.col(other).isNull().alias("missing"), F.col(other), F.col("note_id")
    )
    return (
        rows.groupBy(group)
        .agg(F.min(order).alias("row"))
        .select(group, F.col(f"row.{other}").alias(other), F.col("row.note_id").alias("note_id"))
    )


def level1(
    bridge: DataFrame,
    merchant: DataFrame,
    external: DataFrame,
    flows: DataFrame,
    sales: DataFrame,
) -> DataFrame:
    """One row per bridge row.

    What is known per account goes to the first product on it, what is known
    per product to the first of its accounts; receipts go to every row.
    ``flows`` may be flow rows or flow totals.
    """
    rows = universe(bridge, merchant)
    pulled = external.groupBy("va_number").agg(
        F.sum("buy_amount").cast(TOTAL).alias("amount_pulled")
    )
    sold = sales.groupBy("sku_id").agg(F.sum("sales_proceeds").cast(TOTAL).alias("sales_proceeds"))
    got = received(flows).withColumnRenamed("account_number", "va_number")

    # Totals meet the first rows on their own key, one to one, and then the
    # report on the full bridge key. No join sees a hot product or account.
    carried_pull = first_rows(rows, "va_number").join(pulled, "va_number")
    carried_sale = first_rows(rows, "sku_id").join(sold, "sku_id")
    figures = null_safe_join(rows, carried_pull, BRIDGE_KEYS, "left")
    figures = null_safe_join(figures, carried_sale, BRIDGE_KEYS, "left")
    figures = figures.join(got, ["sku_id", "va_number"], "left")

    pull, receipt, sale = (
        or_zero(F.col(c)) for c in ("amount_pulled", "amount_received", "sales_proceeds")
    )
    return figures.select(
        "sku_id",
        F.col("va_number").alias("account_number"),
        F.col("merchant_name").alias("merchant"),
        pull.alias("amount_pulled"),
        receipt.alias("amount_received"),
        (pull - receipt).alias("variance_pulled_vs_received"),
        sale.alias("sales_proceeds"),
        (sale - receipt).alias("variance_received_vs_sales"),
    )


# Column -> heading of the exported report.
EXPORT_HEADINGS = {
    "sku_id": "SKU ID",
    "account_number": "Account Number",
    "merchant": "Merchant",
    "amount_pulled": "Amount Pulled",
    "amount_received": "Amount Received",
    "variance_pulled_vs_received": "Variance Pulled vs Received",
    "sales_proceeds": "Sales Proceeds",
    "variance_received_vs_sales": "Variance Received vs Sales",
}


def level1_export(mart: DataFrame) -> DataFrame:
    """The mart under its report headings, variances computed again."""
    pull, receipt, sale = (
        or_zero(F.col(c)) for c in ("amount_pulled", "amount_received", "sales_proceeds")
    )
    again = mart.withColumns(
        {
            "variance_pulled_vs_received": pull - receipt,
            "variance_received_vs_sales": sale - receipt,
        }
    )
    return reduce(
        lambda df, names: df.withColumnRenamed(*names), EXPORT_HEADINGS.items(), again
    ).select(*EXPORT_HEADINGS.values())
