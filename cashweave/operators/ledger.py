"""The ledger matched to products: row level, and as totals.

A mart only needs sums. ``flow_totals`` therefore adds the ledger up per
account, direction and category first, with partial sums in every input split,
and matches the few totals to the bridge afterwards: however many rows one
account holds, no task sees more of them than its own split. It has the columns
of ``va_txn_flows`` that sums are taken over, so everything built on flows
accepts either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cashweave.functions.money import signed_amount, zero
from cashweave.functions.parsing import TOTAL, period_ym
from cashweave.operators.categorise import UNCATEGORISED, Rules, categorise, strategy_for
from cashweave.operators.keyed import lookup_join
from cashweave.operators.typed import ledger_rows

# Which inflow counts as received. ``funds_to_sku`` does not.
RECEIVED_CODES = ("merchant_repayment",)

# Waterfall column -> outflow category. No shipped rule gives the
# last three codes; an installation may add rules that do.
PAID_CODES = {
    "admin_fee_paid": "admin_fee",
    "management_fee_paid": "mgmt_fee",
    "interest_difference_paid": "int_diff",
    "sr_principal_paid": "sr_prin",
    "sr_interest_paid": "sr_int",
    "jr_principal_paid": "jr_prin",
    "jr_interest_paid": "jr_int",
    "spar_paid": "spar",
    "additional_admin_fee_paid": "fh_add_admin_fee",
    "sr_add_interest_paid": "senior_add_investor_interest",
    "jr_add_interest_paid": "junior_add_investor_interest",
}


def _bridge_keys(bridge: DataFrame) -> DataFrame:
    return bridge.where(F.col("va_number").isNotNull()).select(
        "va_number", "sku_id", "merchant_id"
    )


def va_txn(raw: DataFrame, rules: Rules, bridge: DataFrame) -> DataFrame:
    """Every ledger row with its category and the receiver's products."""
    rows = categorise(ledger_rows(raw, trim_remarks=False), rules)
    receivers = _bridge_keys(bridge).withColumnRenamed("va_number", "receiver_va")
    return lookup_join(rows, receivers, "receiver_va", "left").select(
        F.coalesce("receiver_va", "sender_va").alias("va_number"),
        "sku_id",
        "merchant_id",
        "category_code",
        "amount",
        "occurred_at_utc",
        "period_ym",
        "remarks",
    )


def legs(rows: DataFrame) -> DataFrame:
    """Two rows per movement, receiver and sender, from one pass."""
    two = F.array(
        F.struct(F.lit("inflow").alias("direction"), F.col("receiver_va").alias("va_number")),
        F.struct(F.lit("outflow").alias("direction"), F.col("sender_va").alias("va_number")),
    )
    return rows.select("*", F.inline(two)).where(F.col("va_number").isNotNull())


def _categorised_legs(raw: DataFrame, rules: Rules) -> DataFrame:
    return legs(categorise(ledger_rows(raw), rules, default=UNCATEGORISED))


def va_txn_flows(raw: DataFrame, rules: Rules, bridge: DataFrame) -> DataFrame:
    """Signed inflow and outflow rows, one per product mapped to the account.

    Where the bridge is too large to be broadcast, all legs are shuffled. So they carry
    only what the rest is told from: the month comes from the moment, and one expression
    gives the category, after the join. Longer rule tables are looked up before it,
    because that reads the rows twice.
    """
    rules = rules if isinstance(rules, DataFrame) else list(rules)
    late = strategy_for(rules) == "case"
    rows = ledger_rows(raw).select(
        "sender_va", "receiver_va", "amount", "occurred_at_utc", "remarks"
    )
    if not late:
        rows = categorise(rows, rules, default=UNCATEGORISED, strategy="join")
    narrow = legs(rows).withColumn("direction", F.col("direction") == "inflow").drop(
        "sender_va", "receiver_va"
    )
    matched = lookup_join(narrow, _bridge_keys(bridge), "va_number").withColumn(
        "direction", F.when(F.col("direction"), "inflow").otherwise("outflow")
    )
    if late:
        matched = categorise(matched, rules, default=UNCATEGORISED, strategy="case")
    return matched.select(
        "va_number",
        "sku_id",
        "merchant_id",
        "category_code",
        "direction",
        F.col("amount").alias("raw_amount"),
        signed_amount(F.col("direction"), F.col("amount")).alias("signed_amount"),
        "occurred_at_utc",
        period_ym(F.col("occurred_at_utc")).alias("period_ym"),
        "remarks",
    )


FLOWS_SCHEMA = (
    "va_number string, sku_id string, merchant_id string, category_code string, "
    "direction string, raw_amount decimal(24,6), signed_amount decimal(24,6), "
    "occurred_at_utc timestamp, remarks string, period_ym string"
)


def totals_of(flows: DataFrame) -> DataFrame:
    """Flow totals out of written flow rows."""
    return flows.groupBy(
        "va_number", "sku_id", "merchant_id", "category_code", "direction"
    ).agg(
        F.sum("raw_amount").alias("raw_amount"),
        F.sum("signed_amount").alias("signed_amount"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def account_totals(raw: DataFrame, rules: Rules) -> DataFrame:
    """Sum and row count per account, direction and category."""
    return (
        _categorised_legs(raw, rules)
        .groupBy("va_number", "direction", "category_code")
        .agg(F.sum("amount").alias("raw_amount"), F.count(F.lit(1)).alias("n_rows"))
    )


def of_products(totals: DataFrame, bridge: DataFrame) -> DataFrame:
    """Flow totals out of account totals."""
    return totals.join(_bridge_keys(bridge), "va_number").select(
        "va_number",
        "sku_id",
        "merchant_id",
        "category_code",
        "direction",
        "raw_amount",
        signed_amount(F.col("direction"), F.col("raw_amount")).alias("signed_amount"),
        "n_rows",
    )


def flow_totals(raw: DataFrame, rules: Rules, bridge: DataFrame) -> DataFrame:
    """``va_txn_flows`` added up per account, direction and category."""
    return of_products(account_totals(raw, rules), bridge)


def received(flows: DataFrame, codes: tuple[str, ...] = RECEIVED_CODES) -> DataFrame:
    """Cash received per product and account that has any inflow.

    The category is tested inside the sum. As a filter it would be pushed below
    the totals and run the whole rule lookup a second time on every ledger row.
    """
    hit = F.when(F.col("category_code").isin(*codes), F.col("signed_amount"))
    return (
        flows.where(F.col("direction") == "inflow")
        .groupBy("sku_id", F.col("va_number").alias("account_number"))
        .agg(F.coalesce(F.sum(hit), F.lit(0)).cast(TOTAL).alias("amount_received"))
    )


def flows_pivot(flows: DataFrame, received_codes: tuple[str, ...] = RECEIVED_CODES) -> DataFrame:
    """Received and the eleven paid buckets per product and merchant.

    Products whose flows fall into no bucket stay, with zeros. A bucket is NULL
    only where all flows of the product fall into it and none has an amount.
    """
    inflow = F.when(F.col("direction") == "inflow", F.col("category_code"))
    outflow = F.when(F.col("direction") == "outflow", F.col("category_code"))
    coded = flows.select(
        "sku_id", "merchant_id", "signed_amount", inflow.alias("in_code"), outflow.alias("out_code")
    )

    def bucket(hit: Column, amount: Column) -> Column:
        # Misses are left out of the sum rather than added as zeros: adding
        # decimals this wide is what the aggregate spends its time on.
        missed = F.count_if(hit) < F.count(F.lit(1))
        return F.coalesce(F.sum(F.when(hit, amount)).cast(TOTAL), F.when(missed, zero()))

    amount = F.col("signed_amount")
    paid = {
        name: bucket(F.col("out_code") == code, -amount) for name, code in PAID_CODES.items()
    }
    return coded.groupBy("sku_id", "merchant_id").agg(
        bucket(F.col("in_code").isin(*received_codes), amount).alias("amount_received"),
        *[column.alias(name) for name, column in paid.items()],
    )


def flow_summary(flows: DataFrame) -> DataFrame:
    """Rows and signed sum per product, category and direction."""
    rows = F.sum("n_rows") if "n_rows" in flows.columns else F.count(F.lit(1))
    return flows.groupBy("sku_id", "category_code", "direction").agg(
        rows.alias("n"), F.sum("signed_amount").cast(TOTAL).alias("sum_signed")
    )


def txn_counts(raw: DataFrame, rules: Rules, bridge: DataFrame) -> DataFrame:
    """Rows of ``va_txn`` per category, without making them.

    The ledger is counted per receiver and category first; a count is then
    worth as many rows as the receiver has in the bridge, and one if none.
    """
    rows = categorise(ledger_rows(raw, trim_remarks=False), rules)
    counts = rows.groupBy("receiver_va", "category_code").agg(F.count(F.lit(1)).alias("n"))
    times = _bridge_keys(bridge).groupBy(F.col("va_number").alias("receiver_va")).agg(
        F.count(F.lit(1)).alias("times")
    )
    worth = F.col("n") * F.coalesce("times", F.lit(1))
    return counts.join(times, "receiver_va", "left").groupBy("category_code").agg(
        F.sum(worth).alias("n")
    )


def category_breakdown(txn: DataFrame) -> DataFrame:
    """Transactions per category, the uncategorised ones under NULL."""
    n = F.sum("n") if "n" in txn.columns else F.count(F.lit(1))
    return txn.groupBy("category_code").agg(n.alias("n"))
