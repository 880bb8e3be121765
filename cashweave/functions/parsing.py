"""Lenient text parsers as Column expressions (no Python UDF).

Every parser returns NULL for text it cannot read; none of them raises, also
with ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# One amount. Sums of it are decimal(34,6), and a rate with two decimals times
# such a sum still keeps every digit within the 38 Spark offers.
AMOUNT = T.DecimalType(24, 6)
TOTAL = T.DecimalType(34, 6)

_NOT_NUMERIC = r"[^0-9.\-]+"

# Two shapes of a leading date; anything after the date (a time of day) is
# ignored. The last branch swallows other text so that it yields no date.
_DATE_SHAPES = (
    r"(?s)^(?:(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}).*"
    r"|(\d{4})[-/.](\d{1,2})[-/.](\d{1,2}).*"
    r"|.*)$"
)
_AS_MONTH_FIRST = "$3$4-$1$5-$2$6"
_AS_DAY_FIRST = "$3-$2-$1"

# What Python's str.strip() takes off, as far as exports contain it.
_WHITESPACE = " \t\r\n\f\u000b\u00a0\ufeff"


def to_numeric_safe(text: Column) -> Column:
    """Amount in free text: only digits, dots and minus signs are kept.

    Parentheses and exponents carry no meaning: ``(45.00)`` is 45.00 and
    ``1e5`` is 15. What is left must be one plain number, else NULL.
    """
    return F.regexp_replace(text, _NOT_NUMERIC, "").try_cast(AMOUNT)


def to_date_safe(text: Column) -> Column:
    """Date in free text: month first, then year first, then day first."""
    trimmed = F.trim(text)
    return F.coalesce(
        F.regexp_replace(trimmed, _DATE_SHAPES, _AS_MONTH_FIRST).try_cast("date"),
        F.regexp_replace(trimmed, _DATE_SHAPES, _AS_DAY_FIRST).try_cast("date"),
    )


def to_tstz_safe(text: Column) -> Column:
    """UTC midnight of :func:`to_date_safe` (the session zone is UTC)."""
    return to_date_safe(text).cast("timestamp")


def period_ym(moment: Column) -> Column:
    """``YYYY-MM`` tag of a date or timestamp."""
    return F.date_format(moment, "yyyy-MM")


def strip_text(text: Column) -> Column:
    """Trim all kinds of white space, not only blanks."""
    return F.btrim(text, F.lit(_WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def accounting_amount(text: Column) -> Column:
    """Amount in a spreadsheet export: blank and ``-`` mean zero."""
    plain = F.replace(strip_text(F.coalesce(text, F.lit(""))), F.lit(","), F.lit(""))
    return F.when(plain.isin("", "-"), F.lit(0).cast(AMOUNT)).otherwise(
        plain.try_cast(AMOUNT)
    )
