from decimal import Decimal

import pytest

from cashweave.operators import ledger
from cashweave.operators.categorise import SHIPPED_RULES
from cashweave.operators.typed import typed_external, typed_sales
from cashweave.plans import level1 as l1, quality
from small import D, bridge, external, merchants, rows, sales
from small import ledger as raw_ledger

MART = (
    "sku_id string, account_number string, merchant string, amount_pulled decimal(18,2), "
    "amount_received decimal(18,2), sales_proceeds decimal(18,2)"
)


def _mart(spark, *entries):
    """Rows (sku, pulled, received[, sales, merchant])."""
    full = []
    for sku, pulled, received, *rest in entries:
        sold, merchant = (rest + ["0", "M"])[:2] if len(rest) < 2 else rest
        full.append((sku, f"V{sku}", merchant, D(pulled), D(received), D(sold)))
    return spark.createDataFrame(full, MART)


def _passed(check):
    row = check.first()
    return row["passed"], row["detail"]


@pytest.mark.parametrize(
    ("gap", "inside"), [("-4.00", True), ("-2.05", True), ("-2.00", False), ("0", False), ("0.06", False), ("-4.01", False)]
)
def test_published_band(spark, gap, inside):
    mart = _mart(spark, ("A", gap, "0"))
    check = quality.check_tolerance(mart)
    assert _passed(check)[0] is inside and check.first()["severity"] == "warn"
    assert quality.outside_band(mart, Decimal("-5"), Decimal("5")).isEmpty()


def test_parity(spark):
    base = ("A", "1.00", "2.00", "3.00", "M")
    expected = _mart(spark, base)
    cases = {
        (base,): (True, "missing=0 extra=0 amount=0 merchant=0"),
        (("A", "1.01", "2.00", "2.99", "M"),): (True, "missing=0 extra=0 amount=0 merchant=0"),
        (("A", "1.02", "2.00", "3.00", "M"),): (False, "missing=0 extra=0 amount=1 merchant=0"),
        (("A", "1.00", "2.00", "3.00", "N"),): (False, "missing=0 extra=0 amount=0 merchant=1"),
        (base, ("B", "0", "0", "0", "M")): (False, "missing=0 extra=1 amount=0 merchant=0"),
        (("B", "0", "0", "0", "M"),): (False, "missing=1 extra=1 amount=0 merchant=0"),
    }
    for actual, wanted in cases.items():
        assert _passed(quality.check_parity(expected, _mart(spark, *actual))) == wanted


def test_coverage_compares_counts_not_sets(spark):
    sold = typed_sales(sales(spark, ("M", "A", "1"), ("M", "B", "1")))
    other = bridge(spark, (None, "A", "V1", "m"), (None, "Z", "V2", "m"))
    assert _passed(quality.check_coverage(sold, other)) == (True, "mapped=2 missing=0")
    assert rows(quality.unmapped_skus(sold, other)) == [("B",)]
    one = bridge(spark, (None, "A", "V1", "m"))
    assert _passed(quality.check_coverage(sold, one)) == (False, "mapped=1 missing=1")


def test_row_counts_under_both_column_names(spark):
    sold = typed_sales(sales(spark, ("M", "A", "1"), ("M", "B", "1")))
    two = spark.createDataFrame([("A",), ("B",), ("B",)], "sku_id string")
    heads = two.withColumnRenamed("sku_id", "SKU ID")
    assert _passed(quality.check_row_counts(sold, two, heads, heads))[0]
    found = _passed(quality.check_row_counts(sold, two, heads.limit(1), heads))
    assert found == (False, "raw=2 level1=2 level2a=1 level2b=2")


def _totals(spark, mapping, pulls):
    table, people = bridge(spark, *mapping), merchants(spark, "m")
    raw = raw_ledger(spark, (None, "VA-1", "4", "merchant-repayment"))
    flows = ledger.flow_totals(raw, SHIPPED_RULES, table)
    bank, sold = typed_external(external(spark, *pulls)), typed_sales(sales(spark, ("M", "A", "7")))
    mart = l1.level1(table, people, bank, flows, sold)
    return quality.check_totals(mart, bank, table, flows, sold)


def test_totals(spark):
    fine = _totals(spark, [(None, "A", "VA-1", "m")], [("VA-1", "5"), ("VA-7", "9")])
    assert _passed(fine) == (
        True,
        "pulled 5.00 of 5.00, received 4.00 of 4.00, sales 7.00 of 7.00",
    )


def test_totals_fail_on_shared_accounts(spark):
    shared = [(None, "A", "VA-1", "m"), (None, "B", "VA-1", "m")]
    assert _passed(_totals(spark, shared, [("VA-1", "5")])) == (
        False,
        "pulled 5.00 of 10.00, received 8.00 of 8.00, sales 7.00 of 7.00",
    )


def test_headers_and_raw_rows(spark):
    fine, bad = (["a", "b"], ["a", "b"]), (["b", "a"], ["a", "b"])
    assert _passed(quality.check_headers(spark, {"x": fine}))[0]
    found = _passed(quality.check_headers(spark, {"x": bad, "y": fine, "z": bad}))
    assert found == (False, "header mismatch: x, z")
    none = spark.createDataFrame([], "a string")
    assert _passed(quality.check_raw_data({"a": none, "b": none})) == (False, "0 raw rows")
    assert _passed(quality.check_raw_data({"a": none, "b": spark.range(3)})) == (True, "3 raw rows")


def test_suite_collects_before_it_raises(spark):
    warn = quality.check_tolerance(_mart(spark, ("A", "0", "0")))
    fine = quality.check_tolerance(_mart(spark, ("A", "-3", "0")), severity=quality.FAIL)
    bad = quality.check_tolerance(_mart(spark, ("A", "0", "0")), severity=quality.FAIL)
    results = quality.enforce(quality.run_checks([warn, fine]))
    assert [(r["severity"], r["passed"]) for r in results] == [("warn", False), ("fail", True)]
    with pytest.raises(quality.ChecksFailed, match="1 rows outside; .*1 rows outside"):
        quality.enforce(quality.run_checks([bad, warn, bad]))


def test_key_differences(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "k string")
    assert rows(quality.key_differences(a, b, ["k"])) == [("x", "left"), ("z", "right")]


def test_a_mart_equals_itself_with_repeated_and_missing_keys(spark):
    schema = "sku_id string, account_number string, merchant string, amount_pulled decimal(18,2), amount_received decimal(18,2), sales_proceeds decimal(18,2)"
    one = [("A", "V", "m", D(1), D(2), D(3)), ("A", "V", "m", D(9), D(0), None), ("A", None, "m", D(0), D(0), D(0)), (None, None, None, None, None, None), ("A", None, "n", D(5), D(0), D(0))]
    mart = spark.createDataFrame(one, schema)
    assert quality.parity_differences(mart, mart).collect() == []
    other = spark.createDataFrame([*one[1:], ("A", "V", "m", D(1), D(7), D(3)), ("A", "V", "m", D(10), D(0), D(0))], schema)
    assert rows(quality.parity_differences(mart, other), "problem") == [("amount",), ("extra",)]
