"""Level 2: the repayment waterfall (a) and reported versus ledger totals (b)."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from cashweave.functions.money import or_zero, overpaid, settled
from cashweave.functions.parsing import TOTAL


class Bucket(NamedTuple):
    """One step of the waterfall and where its figures come from."""

    name: str
    paid: str
    expected: str
    flag: str | None = None


# Heading, paid column of the flows pivot, expected column of the
# repayment feed, and the short heading of the Yes/No flags if there are any.
WATERFALL = [
    Bucket("Management Fee", "management_fee_paid", "acquirer_fees_expected", "Mgmt Fee"),
    Bucket("Administrative Fee", "admin_fee_paid", "fh_admin_fees_expected", "Admin Fee"),
    Bucket(
        "Additional Administrative Fee",
        "additional_admin_fee_paid",
        "additional_admin_fee_expected",
    ),
    Bucket(
        "Interest Difference", "interest_difference_paid", "int_difference_expected", "Int Diff"
    ),
    Bucket("Senior Principal", "sr_principal_paid", "sr_principal_expected", "Sr Principal"),
    Bucket("Senior Interest", "sr_interest_paid", "sr_interest_expected", "Sr Interest"),
    Bucket("Senior Additional Interest", "sr_add_interest_paid", "sr_add_interest_expected"),
    Bucket("Junior Principal", "jr_principal_paid", "jr_principal_expected", "Jr Principal"),
    Bucket("Junior Interest", "jr_interest_paid", "jr_interest_expected", "Jr Interest"),
    Bucket("Junior Additional Interest", "jr_add_interest_paid", "jr_add_interest_expected"),
    Bucket("SPAR", "spar_paid", "spar_merchant"),
]


def _sum_or_zero(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast(TOTAL)


def expected_by_sku(expected: DataFrame, sku: DataFrame) -> DataFrame:
    """Expected buckets per known product, under its merchant.

    Added up before the join: the product gives the merchant.
    """
    sums = expected.groupBy("sku_id").agg(
        *[_sum_or_zero(b.expected).alias(b.expected) for b in WATERFALL]
    )
    return sums.join(sku.select("sku_id", "merchant_id"), "sku_id")


def inflow_sources(sales: DataFrame) -> DataFrame:
    names = ["sales_proceeds", "merchant_top_up", "disbursement_surplus"]
    return sales.groupBy("sku_id").agg(*[_sum_or_zero(n).alias(n) for n in names])


def level2a(
    pivot: DataFrame,
    expected: DataFrame,
    sku: DataFrame,
    sales: DataFrame,
    transfers: DataFrame,
    merchant: DataFrame,
) -> DataFrame:
    """Paid, expected and outstanding per product and merchant.

    A product known on one side only keeps NULLs on the other, also in whatever
    is computed from both, and its flags say No. Every input has one row per
    key by now, so hot products of the ledger are long gone.
    """
    key = ["sku_id", "merchant_id"]
    paid = pivot.withColumns(
        {c: or_zero(F.col(c)).cast(TOTAL) for c in pivot.columns if c not in key}
    )
    both = paid.join(expected_by_sku(expected, sku), key, "full")
    rows = (
        both.join(inflow_sources(sales), "sku_id", "left")
        .join(transfers, key, "left")
        .join(merchant.select("merchant_id", "merchant_name"), "merchant_id", "left")
    )

    got = F.col("amount_received")
    spent = reduce(lambda a, b: a + b, [F.col(b.paid) for b in WATERFALL])
    moved_out = or_zero(F.col("transfer_out_to_other_sku"))
    moved_in = or_zero(F.col("transfer_in_from_other_sku"))
    sold, topped_up, surplus = (
        or_zero(F.col(c)) for c in ("sales_proceeds", "merchant_top_up", "disbursement_surplus")
    )
    flagged = [b for b in WATERFALL if b.flag]
    return rows.select(
        F.col("sku_id").alias("SKU ID"),
        F.col("merchant_name").alias("Merchant"),
        got.alias("Amount Received"),
        spent.alias("Amount Distributed Down the Repayment Waterfall"),
        moved_out.alias("Fund Transferred to Other SKU"),
        (got + moved_in - spent - moved_out).alias("Variance"),
        *[
            overpaid(F.col(b.paid), F.col(b.expected)).alias(f"{b.flag} Paid > Expected?")
            for b in flagged
        ],
        *[settled(F.col(b.paid), F.col(b.expected)).alias(f"{b.flag} Settled?") for b in flagged],
        sold.alias("Sales Proceeds"),
        topped_up.alias("Merchant Top Up"),
        surplus.alias("Disbursement Surplus"),
        moved_in.alias("Fund Transferred from Other SKU"),
        (got - sold - topped_up - surplus).alias("Other"),
        *[F.col(b.paid).alias(f"{b.name} Paid") for b in WATERFALL],
        *[F.col(b.expected).alias(f"{b.name} Expected") for b in WATERFALL],
        *[
            (F.col(b.expected) - F.col(b.paid)).alias(f"{b.name} Outstanding")
            for b in WATERFALL
        ],
    )


# The buckets of the short preview, without the additional ones.
_PREVIEW = [b.name for b in WATERFALL if "Additional" not in b.name]
PREVIEW_COLUMNS = [
    "SKU ID",
    "Merchant",
    "Amount Received",
    *[f"{name} Paid" for name in _PREVIEW],
    "Amount Distributed Down the Repayment Waterfall",
    *[f"{name} Expected" for name in _PREVIEW],
    *[f"{name} Outstanding" for name in _PREVIEW if name != "SPAR"],
    "Fund Transferred to Other SKU",
    "Fund Transferred from Other SKU",
]


class Reported(NamedTuple):
    """A figure both the reported totals and the ledger give."""

    name: str
    reported: str
    ledger: str


# Heading, column of the repayment feed, column of the pivot.
COMPARED = [
    Reported("Management Fee Paid", "acquirer_fees_paid", "management_fee_paid"),
    Reported("Administrative Fee Paid", "fh_admin_fees_paid", "admin_fee_paid"),
    Reported("Interest Difference Paid", "int_difference_paid", "interest_difference_paid"),
    Reported("Senior Principal Paid", "sr_principal_paid", "sr_principal_paid"),
    Reported("Senior Interest Paid", "sr_interest_paid", "sr_interest_paid"),
    Reported("Junior Principal Paid", "jr_principal_paid", "jr_principal_paid"),
    Reported("Junior Interest Paid", "jr_interest_paid", "jr_interest_paid"),
    Reported("SPAR", "spar_merchant", "spar_paid"),
]

# The report spells this heading so.
_CASH_HEADINGS = {"Administrative Fee Paid": "Adminstrative Fee Paid"}

PLATFORM_FEE_RATE = Decimal("0.10")


def level2b(
    sku: DataFrame,
    merchant: DataFrame,
    sales: DataFrame,
    expected: DataFrame,
    pivot: DataFrame,
    fee_rate: Decimal = PLATFORM_FEE_RATE,
) -> DataFrame:
    """Reported (UI) and ledger (CF) totals per product, and what they differ by.

    Anything missing counts as zero. The platform fee of the ledger is computed
    from both interests.
    """
    ui_inflow = sales.groupBy("sku_id").agg(_sum_or_zero("total_funds_inflow").alias("ui_inflow"))
    ui_paid = expected.groupBy("sku_id").agg(
        *[_sum_or_zero(r.reported).alias(f"ui_{r.reported}") for r in COMPARED],
        _sum_or_zero("additional_interests_paid_to_fh").alias("ui_platform"),
    )
    cash = pivot.select(
        "sku_id",
        F.col("amount_received").alias("cf_inflow"),
        *[F.col(r.ledger).alias(f"cf_{r.ledger}") for r in COMPARED],
    )
    rows = (
        sku.join(merchant.select("merchant_id", "merchant_name"), "merchant_id")
        .join(ui_inflow, "sku_id", "left")
        .join(ui_paid, "sku_id", "left")
        .join(cash, "sku_id", "left")
    )

    def figure(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast(TOTAL)

    inflow_ui, inflow_cf = figure("ui_inflow"), figure("cf_inflow")
    ui = {r.name: figure(f"ui_{r.reported}") for r in COMPARED}
    cf = {r.name: figure(f"cf_{r.ledger}") for r in COMPARED}
    interest = cf["Senior Interest Paid"] + cf["Junior Interest Paid"]
    fee_ui, fee_cf = figure("ui_platform"), interest * F.lit(fee_rate)
    return rows.select(
        F.col("sku_id").alias("SKU ID"),
        F.col("merchant_name").alias("Merchant"),
        inflow_cf.alias("Total Fund Inflow"),
        *[cf[r.name].alias(_CASH_HEADINGS.get(r.name, r.name)) for r in COMPARED],
        fee_cf.alias("FH Platform Fee"),
        (inflow_ui - inflow_cf).alias("Total Fund Inflow Variance"),
        *[(ui[r.name] - cf[r.name]).alias(f"{r.name} Variance") for r in COMPARED],
        (fee_ui - fee_cf).alias("FH Platform Fee Variance"),
        *[
            column
            for r in COMPARED
            for column in (
                ui[r.name].alias(f"{r.name} (UI)"),
                cf[r.name].alias(f"{r.name} (CF)"),
            )
        ],
        fee_ui.alias("FH Platform Fee (UI)"),
        fee_cf.alias("FH Platform Fee (Calc.)"),
        inflow_ui.alias("Total Fund Inflow (UI)"),
        inflow_cf.alias("Amount Received (CF)"),
    )
