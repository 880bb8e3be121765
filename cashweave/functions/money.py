"""Amount arithmetic and the flags derived from it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from cashweave.functions.parsing import AMOUNT

CENTS = T.DecimalType(18, 2)


def zero() -> Column:
    return F.lit(0).cast(AMOUNT)


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, zero())


def signed_amount(direction: Column, amount: Column) -> Column:
    """Inflows count up, everything else counts down."""
    return F.when(direction == "inflow", amount).otherwise(-amount)


def round_cents(amount: Column) -> Column:
    """Two decimals, halves away from zero."""
    return F.round(amount, 2)


def to_cents(amount: Column) -> Column:
    """Two decimals as a fixed type, for exports."""
    return F.round(amount, 2).cast(CENTS)


def yes_no(condition: Column) -> Column:
    """NULL conditions count as No."""
    return F.when(condition, "Yes").otherwise("No")


def overpaid(paid: Column, expected: Column) -> Column:
    return yes_no(paid > expected)


def settled(paid: Column, expected: Column) -> Column:
    return yes_no(expected - paid <= 0)
