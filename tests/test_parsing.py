import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashweave.functions import money, names, parsing


def _values(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_amounts(spark):
    cases = {
        "1,234.50": "1234.50",
        "RM 12.3": "12.3",
        "(45.00)": "45.00",
        "1e5": "15",
        "5.": "5",
        ".5": "0.5",
        "-7": "-7",
        "-": None,
        " ": None,
        "": None,
        "5-3": None,
        "1.2.3": None,
        "--7": None,
        None: None,
    }
    found = _values(spark, parsing.to_numeric_safe, list(cases))
    assert found == [None if v is None else Decimal(v) for v in cases.values()]


def test_dates(spark):
    sept = dt.date(2025, 9, 30)
    cases = {
        "9/30/2025": sept,
        "9/30/2025 14:22": sept,
        " 2025-09-30 01:02:03": sept,
        "2025/9/3": dt.date(2025, 9, 3),
        "13/09/2025": dt.date(2025, 9, 13),
        "05/09/2025": dt.date(2025, 5, 9),
        "9-30-2025": sept,
        "31/02/2025": None,
        "junk": None,
        "2025": None,
        "9/30/25": None,
        "": None,
        None: None,
    }
    assert _values(spark, parsing.to_date_safe, list(cases)) == list(cases.values())
    stamps = _values(spark, parsing.to_tstz_safe, list(cases))
    assert [None if s is None else s.date() for s in stamps] == list(cases.values())
    periods = _values(spark, lambda c: parsing.period_ym(parsing.to_date_safe(c)), list(cases))
    assert periods == [None if d is None else f"{d:%Y-%m}" for d in cases.values()]


def test_accounting_amounts(spark):
    cases = {"1,012.48": "1012.48", " - ": "0", "": "0", None: "0", "\t5 ": "5", "x": None}
    found = _values(spark, parsing.accounting_amount, list(cases))
    assert found == [None if v is None else Decimal(v) for v in cases.values()]


def test_halves_round_away_from_zero(spark):
    def cents(c):
        return money.to_cents(c.cast("decimal(24,6)"))

    found = _values(spark, cents, ["1.005", "-1.005", "2.344999"])
    assert found == [Decimal("1.01"), Decimal("-1.01"), Decimal("2.34")]


@pytest.mark.parametrize(
    ("paid", "expected", "over", "done"),
    [("5", "4", "Yes", "Yes"), ("4", "4", "No", "Yes"), ("3", "4", "No", "No"), (None, "4", "No", "No"), ("4", None, "No", "No")],
)
def test_flags(spark, paid, expected, over, done):
    df = spark.createDataFrame([(paid, expected)], "p string, e string").select(
        F.col("p").cast("decimal(24,6)").alias("p"), F.col("e").cast("decimal(24,6)").alias("e")
    )
    row = df.select(
        money.overpaid(F.col("p"), F.col("e")), money.settled(F.col("p"), F.col("e"))
    ).first()
    assert tuple(row) == (over, done)


def test_header_names_agree_in_python_and_spark(spark):
    raw = ["  Sku-ID ", "L2+E", "Buy  Amount (MYR)", "", "é x"]
    keys = ["sku id", "l2 e", "buy amount myr", "", "x"]
    assert [names.normalise_header(h) for h in raw] == keys
    assert _values(spark, names.header_key, raw) == keys


def test_merchant_names(spark):
    assert _values(spark, names.merchant_norm, ["ABC  Sdn\tBhd"]) == ["abc sdn bhd"]
    first, second = _values(spark, names.merchant_key, ["ABC", "ABC"])
    assert first == second and len(first) == 64


def test_trim_takes_blanks_only(spark):
    assert _values(spark, F.trim, ["  a ", "\ta"]) == ["a", "\ta"]
