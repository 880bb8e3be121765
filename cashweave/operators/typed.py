"""Typed projections of the four text feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cashweave.functions.money import zero
from cashweave.functions.parsing import (
    blank_to_null,
    period_ym,
    to_numeric_safe,
    to_tstz_safe,
)

# Measures of the repayment feed, in feed order.
REPAYMENT_MEASURES = [
    "acquirer_fees_expected",
    "acquirer_fees_paid",
    "fh_admin_fees_expected",
    "fh_admin_fees_paid",
    "int_difference_expected",
    "int_difference_paid",
    "sr_principal_expected",
    "sr_principal_paid",
    "sr_interest_expected",
    "sr_interest_paid",
    "jr_principal_expected",
    "jr_principal_paid",
    "jr_interest_expected",
    "jr_interest_paid",
    "spar_merchant",
    "additional_interests_paid_to_fh",
]

# Measures the marts ask for but no feed carries yet; always 0.
EXPECTED_PLACEHOLDERS = [
    "additional_admin_fee_expected",
    "sr_add_interest_expected",
    "jr_add_interest_expected",
]
SALES_MEASURES = ["total_funds_inflow", "sales_proceeds", "l2e"]
SALES_PLACEHOLDERS = ["merchant_top_up", "disbursement_surplus"]


def typed_external(raw: DataFrame) -> DataFrame:
    """Bank pulls per virtual account."""
    created = to_tstz_safe(F.col("created_date"))
    return raw.select(
        F.trim("beneficiary_bank_account_number").alias("va_number"),
        to_numeric_safe(F.col("buy_amount")).alias("buy_amount"),
        F.trim("buy_currency").alias("buy_currency"),
        created.alias("created_at_utc"),
        period_ym(created).alias("period_ym"),
    )


def _typed_measures(raw: DataFrame, measures: list[str], constants: list[str]) -> DataFrame:
    return raw.select(
        F.trim("merchant").alias("merchant_name"),
        F.trim("sku_id").alias("sku_id"),
        *[to_numeric_safe(F.col(m)).alias(m) for m in measures],
        *[zero().alias(c) for c in constants],
    )


def typed_expected(raw: DataFrame) -> DataFrame:
    """Repayments expected and reported as paid per SKU."""
    return _typed_measures(raw, REPAYMENT_MEASURES, EXPECTED_PLACEHOLDERS)


def typed_sales(raw: DataFrame) -> DataFrame:
    """Reported inflows and sales proceeds per SKU."""
    return _typed_measures(raw, SALES_MEASURES, SALES_PLACEHOLDERS)


def typed_ledger(raw: DataFrame, trim_remarks: bool = True) -> DataFrame:
    """Account movements. Account numbers stay as they are, untrimmed.

    Remarks are lower case and never NULL. Only the flows trim them; the plain
    transaction table does not, so a padded remark matches no exact rule there.
    """
    remarks = F.coalesce("remarks", F.lit(""))
    if trim_remarks:
        remarks = F.trim(remarks)
    occurred = to_tstz_safe(F.col("date"))
    return raw.select(
        "sender_virtual_account_id",
        F.col("sender_virtual_account_number").alias("sender_va"),
        blank_to_null(F.col("sender_note_id")).alias("sender_note_id"),
        "receiver_virtual_account_id",
        F.col("receiver_virtual_account_number").alias("receiver_va"),
        blank_to_null(F.col("receiver_note_id")).alias("receiver_note_id"),
        to_numeric_safe(F.col("receiver_va_opening_balance")).alias("r_opening_bal"),
        to_numeric_safe(F.col("receiver_va_closing_balance")).alias("r_closing_bal"),
        to_numeric_safe(F.col("amount")).alias("amount"),
        occurred.alias("occurred_at_utc"),
        period_ym(occurred).alias("period_ym"),
        F.lower(remarks).alias("remarks"),
    )


def ledger_rows(ledger: DataFrame, trim_remarks: bool = True) -> DataFrame:
    """``typed_ledger`` of a raw ledger, or of one that was typed untrimmed and written before."""
    if "sender_va" not in ledger.columns:
        return typed_ledger(ledger, trim_remarks)
    return ledger.withColumn("remarks", F.trim("remarks")) if trim_remarks else ledger


def pull_totals(external: DataFrame) -> DataFrame:
    """Bank pulls per account. Marts and checks take sums of these as of the rows."""
    return external.groupBy("va_number").agg(
        F.sum("buy_amount").alias("buy_amount"), F.count(F.lit(1)).alias("n_rows")
    )


_SALES_MEASURES = ("total_funds_inflow", "sales_proceeds", "merchant_top_up", "disbursement_surplus")


def sale_totals(sales: DataFrame) -> DataFrame:
    """Sales per product, likewise."""
    return sales.groupBy("sku_id").agg(
        *[F.sum(m).alias(m) for m in _SALES_MEASURES], F.count(F.lit(1)).alias("n_rows")
    )
