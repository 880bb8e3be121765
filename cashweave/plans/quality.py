"""Data-quality checks. Each gives one row: check, severity, passed, detail."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cashweave.operators.keyed import null_safe_join
from cashweave.operators.ledger import RECEIVED_CODES
from cashweave.plans import parity
from cashweave.plans.parity import CENT, parity_differences

FAIL, WARN = "fail", "warn"
RESULT_SCHEMA = "check string, severity string, passed boolean, detail string"

# The variance band as the published rule has it. Its upper bound
# excludes an exact zero variance.
PUBLISHED_BAND = (Decimal("-4.00"), Decimal("-2.05"))


def _result(facts: DataFrame, check: str, severity: str, passed: Column, detail: Column) -> DataFrame:
    """One row out of one row of facts. An unknown outcome has not passed."""
    return facts.select(
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.alias("detail"),
    )


def _text(template: str, *columns: Column) -> Column:
    """``{}`` in the template stand for columns; NULL prints as NULL."""
    parts = template.split("{}")
    pieces: list[Column] = [F.lit(parts[0])]
    for column, part in zip(columns, parts[1:], strict=True):
        pieces += [F.coalesce(column.cast("string"), F.lit("NULL")), F.lit(part)]
    return F.concat(*pieces)


def _side_by_side(*frames: DataFrame) -> DataFrame:
    """One row with the columns of all frames, which have one row each."""

    def values(df: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in df.columns]
        return df.select(F.inline(F.array(*pairs)))

    return reduce(DataFrame.unionByName, [values(df) for df in frames]).agg(
        *[
            F.max(F.when(F.col("name") == name, F.col("value"))).alias(name)
            for df in frames
            for name in df.columns
        ]
    )


def _cents_text(amount: Column) -> Column:
    return F.round(amount, 2).cast("decimal(38,2)")


def sku_column(mart: DataFrame) -> str:
    """``sku_id`` where the mart has it, else its report heading."""
    return "sku_id" if "sku_id" in mart.columns else "SKU ID"


def _distinct_skus(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count_distinct(F.col(f"`{sku_column(df)}`")).alias(name))


def check_headers(spark: SparkSession, headers: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """Found against expected header per file; all mismatches are listed."""
    wrong = [name for name, (found, expected) in headers.items() if found != expected]
    detail = "headers match" if not wrong else "header mismatch: " + ", ".join(wrong)
    return spark.createDataFrame([("csv_headers", FAIL, not wrong, detail)], RESULT_SCHEMA)


def check_raw_data(tables: dict[str, DataFrame]) -> DataFrame:
    """There is at least one row in any raw table."""
    facts = _side_by_side(
        *[df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    )
    return raw_data_result(facts, reduce(lambda a, b: a + b, [F.col(name) for name in tables]))


def raw_data_result(facts: DataFrame, total: Column) -> DataFrame:
    """The check out of a count that is known already."""
    return _result(facts, "raw_data", FAIL, total > 0, _text("{} raw rows", total))


def check_coverage(sales: DataFrame, bridge: DataFrame, severity: str = WARN) -> DataFrame:
    """As many mapped products as products in sales. Counts, not sets."""
    facts = _side_by_side(_distinct_skus(sales, "expected"), _distinct_skus(bridge, "mapped"))
    expected, mapped = F.col("expected"), F.col("mapped")
    return _result(
        facts,
        "mapping_coverage",
        severity,
        mapped == expected,
        _text("mapped={} missing={}", mapped, expected - mapped),
    )


def unmapped_skus(sales: DataFrame, bridge: DataFrame) -> DataFrame:
    """Products in sales without any bridge row."""
    return sales.select("sku_id").distinct().join(bridge.select("sku_id"), "sku_id", "left_anti")


def check_row_counts(
    sales: DataFrame, level1: DataFrame, level2a: DataFrame, level2b: DataFrame
) -> DataFrame:
    """Every mart has as many products as sales has."""
    facts = _side_by_side(
        _distinct_skus(sales, "raw"),
        _distinct_skus(level1, "level1"),
        _distinct_skus(level2a, "level2a"),
        _distinct_skus(level2b, "level2b"),
    )
    same = reduce(
        lambda a, b: a & b, [F.col(m) == F.col("raw") for m in ("level1", "level2a", "level2b")]
    )
    return _result(
        facts,
        "mart_row_counts",
        FAIL,
        same,
        _text("raw={} level1={} level2a={} level2b={}", *[F.col(c) for c in facts.columns]),
    )


def check_totals(
    level1: DataFrame,
    external: DataFrame,
    bridge: DataFrame,
    flows: DataFrame,
    sales: DataFrame,
    tolerance: Decimal = CENT,
) -> DataFrame:
    """Mart totals against their sources.

    The pulled total counts an account once per bridge row, while the mart
    counts it once: accounts shared by products fail this check.
    """
    # Per account first, so that no pull is repeated before it is added up.
    mapped = bridge.groupBy("va_number").agg(F.count(F.lit(1)).cast("decimal(10,0)").alias("times"))
    pulls = external.groupBy("va_number").agg(F.sum("buy_amount").alias("amount"))
    receipt = (F.col("category_code").isin(*RECEIVED_CODES)) & (F.col("direction") == "inflow")
    # The mart once for all three of its totals.
    per_sku = level1.groupBy("sku_id").agg(
        F.sum("amount_pulled").alias("pulled"),
        F.sum("amount_received").alias("received"),
        F.max("sales_proceeds").alias("sales"),
    )

    def total(column: Column, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(38,6)").alias(name)

    facts = _side_by_side(
        per_sku.agg(*[total(F.col(m), f"mart_{m}") for m in ("pulled", "received", "sales")]),
        pulls.join(mapped, "va_number").agg(total(F.col("amount") * F.col("times"), "raw_pulled")),
        flows.agg(total(F.when(receipt, F.col("signed_amount")), "raw_received")),
        sales.agg(total(F.col("sales_proceeds"), "raw_sales")),
    )
    measures = ("pulled", "received", "sales")
    close = [
        F.abs(F.col(f"mart_{m}") - F.col(f"raw_{m}")) <= F.lit(tolerance) for m in measures
    ]
    return _result(
        facts,
        "level1_totals",
        FAIL,
        reduce(lambda a, b: a & b, close),
        _text(
            "pulled {} of {}, received {} of {}, sales {} of {}",
            *[_cents_text(F.col(f"{side}_{m}")) for m in measures for side in ("mart", "raw")],
        ),
    )


def outside_band(level1: DataFrame, low: Decimal, high: Decimal) -> DataFrame:
    """Rows whose pulled-minus-received variance is not within [low, high]."""
    return level1.where(is_outside(low, high))


def is_outside(low: Decimal, high: Decimal) -> Column:
    zero = F.lit(0)
    gap = F.coalesce("amount_pulled", zero) - F.coalesce("amount_received", zero)
    return (gap < F.lit(low)) | (gap > F.lit(high))


def check_tolerance(
    level1: DataFrame,
    band: tuple[Decimal, Decimal] = PUBLISHED_BAND,
    severity: str = WARN,
) -> DataFrame:
    facts = outside_band(level1, *band).agg(F.count(F.lit(1)).alias("n"))
    return tolerance_result(facts, severity)


def tolerance_result(facts: DataFrame, severity: str = WARN) -> DataFrame:
    """The check out of a count ``n`` that is known already."""
    return _result(
        facts, "level1_tolerance", severity, F.col("n") == 0, _text("{} rows outside", F.col("n"))
    )


def check_parity(expected: DataFrame, actual: DataFrame, tolerance: Decimal = CENT) -> DataFrame:
    """Both sides have the same keys, amounts and merchants."""
    kinds = parity.PROBLEMS
    facts = parity.parity_counts(expected, actual, tolerance).agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds]
    )
    clean = reduce(lambda a, b: a & b, [F.col(k) == 0 for k in kinds])
    return _result(
        facts,
        "level1_parity",
        FAIL,
        clean,
        _text("missing={} extra={} amount={} merchant={}", *[F.col(k) for k in kinds]),
    )


def key_differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on one side only."""

    def only(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        found = null_safe_join(a.select(*keys).distinct(), b.select(*keys), keys, "left_anti")
        return found.withColumn("found_in", F.lit(name))

    return only(left, right, "left").unionByName(only(right, left, "right"))


def run_checks(checks: list[DataFrame]) -> DataFrame:
    """All results in one frame; nothing stops at the first failure."""
    return reduce(DataFrame.unionByName, checks)


class ChecksFailed(AssertionError):
    """At least one check of severity ``fail`` did not pass."""


def enforce(results: DataFrame) -> list:
    """Evaluate all checks, then raise if a ``fail`` one did not pass.

    Returns the result rows, one per check.
    """
    rows = results.collect()
    failed = [r for r in rows if r["severity"] == FAIL and not r["passed"]]
    if failed:
        raise ChecksFailed("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
    return rows
