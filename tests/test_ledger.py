import re
from decimal import Decimal

from pyspark.sql import functions as F

from cashweave.operators import ledger
from cashweave.operators.categorise import SHIPPED_RULES, Rule
from small import D, bridge, rows
from small import ledger as raw_ledger


def _both(spark, raw, mapping, rules=SHIPPED_RULES):
    return (
        ledger.va_txn_flows(raw, rules, mapping),
        ledger.flow_totals(raw, rules, mapping),
    )


def test_a_shared_account_fans_out(spark):
    raw = raw_ledger(spark, ("VA-9", "VA-1", "100", "merchant-repayment"))
    mapping = bridge(spark, (None, "A", "VA-1", "m"), (None, "B", "VA-1", "m"))
    for flows in _both(spark, raw, mapping):
        assert rows(ledger.received(flows)) == [("A", "VA-1", D(100)), ("B", "VA-1", D(100))]


def test_two_notes_match_twice(spark):
    raw = raw_ledger(spark, (None, "VA-1", "10", "merchant-repayment"))
    mapping = bridge(spark, ("N1", "A", "VA-1", "m"), ("N2", "A", "VA-1", "m"))
    for flows in _both(spark, raw, mapping):
        assert rows(ledger.received(flows)) == [("A", "VA-1", D(20))]
        assert rows(ledger.flow_summary(flows), "n", "sum_signed") == [(2, D(20))]


def test_both_legs_of_one_movement(spark):
    raw = raw_ledger(spark, ("VA-1", "VA-2", "7.5", "fh-admin-fee"))
    mapping = bridge(spark, (None, "A", "VA-1", "m"), (None, "B", "VA-2", "m"))
    flows, totals = _both(spark, raw, mapping)
    legs = [("A", "outflow", D("-7.5")), ("B", "inflow", D("7.5"))]
    for df in (flows, totals):
        assert rows(df, "sku_id", "direction", "signed_amount") == legs
    assert rows(ledger.flows_pivot(totals), "sku_id", "admin_fee_paid") == [
        ("A", D("7.5")),
        ("B", D(0)),
    ]


def test_unmapped_and_padded_accounts(spark):
    raw = raw_ledger(
        spark, ("VA-8", "VA-9", "1", "spar"), (None, " VA-1 ", "2", "spar"), ("VA-7", None, "3", "x")
    )
    mapping = bridge(spark, (None, "A", "VA-1", "m"))
    for flows in _both(spark, raw, mapping):
        assert flows.count() == 0
    txn = ledger.va_txn(raw, SHIPPED_RULES, mapping)
    assert rows(txn, "va_number", "sku_id", "category_code") == [
        (" VA-1 ", None, "spar"),
        ("VA-7", None, None),
        ("VA-9", None, "spar"),
    ]


def test_remarks_are_trimmed_in_flows_only(spark):
    raw = raw_ledger(spark, (None, "VA-1", "1", " Merchant-Repayment "))
    mapping = bridge(spark, (None, "A", "VA-1", "m"))
    flow = ledger.va_txn_flows(raw, SHIPPED_RULES, mapping).first()
    assert (flow["category_code"], flow["remarks"]) == ("merchant_repayment", "merchant-repayment")
    txn = ledger.va_txn(raw, SHIPPED_RULES, mapping).first()
    assert (txn["category_code"], txn["remarks"]) == (None, " merchant-repayment ")
    assert rows(ledger.category_breakdown(ledger.va_txn(raw, SHIPPED_RULES, mapping))) == [(None, 1)]


def test_uncategorised_rows_and_periods(spark):
    raw = raw_ledger(
        spark, (None, "VA-1", "1", None, "2025-08-31"), (None, "VA-1", "1", "", "pending")
    )
    flows = ledger.va_txn_flows(raw, SHIPPED_RULES, bridge(spark, (None, "A", "VA-1", "m")))
    assert rows(flows, "category_code", "period_ym") == [
        ("uncategorized", None),
        ("uncategorized", "2025-08"),
    ]


def test_sums_without_amounts_stay_null(spark):
    mapping = bridge(spark, (None, "A", "VA-1", "m"), (None, "B", "VA-2", "m"))
    raw = raw_ledger(
        spark,
        (None, "VA-1", "n/a", "merchant-repayment"),
        (None, "VA-2", "n/a", "merchant-repayment"),
        (None, "VA-2", "n/a", "spar"),
    )
    plain = F.sum(
        F.when(
            (F.col("direction") == "inflow") & (F.col("category_code") == "merchant_repayment"),
            F.col("signed_amount"),
        ).otherwise(0)
    )
    flows, totals = _both(spark, raw, mapping)
    wanted = [("A", None), ("B", D(0))]
    assert rows(flows.groupBy("sku_id").agg(plain.alias("s"))) == wanted
    for df in (flows, totals):
        assert rows(ledger.flows_pivot(df), "sku_id", "amount_received") == wanted


def test_received_codes_are_a_choice(spark):
    raw = raw_ledger(spark, (None, "VA-1", "1", "merchant-repayment"), (None, "VA-1", "2", "transfer-to-sku"))
    totals = ledger.flow_totals(raw, SHIPPED_RULES, bridge(spark, (None, "A", "VA-1", "m")))
    codes = ("merchant_repayment", "funds_to_sku")
    assert ledger.flows_pivot(totals).first()["amount_received"] == 1
    assert ledger.flows_pivot(totals, codes).first()["amount_received"] == 3
    assert ledger.received(totals, codes).first()["amount_received"] == 3


def test_additional_buckets_fill_from_added_rules(spark):
    added = SHIPPED_RULES + [Rule("late fee", "fh_add_admin_fee", False, 5)]
    raw = raw_ledger(spark, ("VA-1", None, "4", "Late Fee"))
    totals = ledger.flow_totals(raw, added, bridge(spark, (None, "A", "VA-1", "m")))
    assert ledger.flows_pivot(totals).first()["additional_admin_fee_paid"] == Decimal(4)


def test_the_ledger_is_added_up_before_it_is_shuffled(spark, capsys):
    raw = raw_ledger(spark, ("VA-1", "VA-2", "1", "spar"))
    ledger.flow_totals(raw, SHIPPED_RULES, bridge(spark, (None, "A", "VA-1", "m"))).explain()
    plan = capsys.readouterr().out
    first = re.search(r"Exchange hashpartitioning\(va_number#\d+, direction#\d+, category", plan)
    # Below the only exchange of the ledger, that is before it.
    assert plan.index("partial_sum(amount") > first.start()


def test_legs_carry_only_what_the_rest_is_told_from(spark, monkeypatch):
    """Month, category and the words for the direction are made behind the join with the bridge."""
    seen = []
    plain = ledger.lookup_join

    def noted(left, *args):
        seen.append(sorted(left.columns))
        return plain(left, *args)

    monkeypatch.setattr(ledger, "lookup_join", noted)
    raw = raw_ledger(spark, ("A", "B", "5", " Merchant-Repayment ", "9/30/2025"), ("B", None, "x", None, "?"))
    mapping = bridge(spark, (None, "S1", "A", "m"), (None, "S2", "B", "m"))
    found = rows(
        ledger.va_txn_flows(raw, SHIPPED_RULES, mapping), "sku_id", "direction", "category_code", "period_ym"
    )
    assert found == [
        ("S1", "outflow", "merchant_repayment", "2025-09"),
        ("S2", "inflow", "merchant_repayment", "2025-09"),
        ("S2", "outflow", "uncategorized", None),
    ]
    assert seen == [["amount", "direction", "occurred_at_utc", "remarks", "va_number"]]
